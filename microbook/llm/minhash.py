"""Near-duplicate documents by one-permutation hashing.

Each shingle set is hashed once; the least hash of each bin is its sketch, and an empty bin borrows from a bin that a hash of
(bin, attempt) names (optimal densification). Bands of the sketch are buckets. In a bucket every document is paired with two
hubs, the document that shares most buckets with others and one picked by hash, so pairs grow with the rows and never with the
square of a bucket. Pairs are confirmed on full sets, and links are closed to components by alternating stars.
Buckets of three documents or more with more than one component left are searched again on longer bands; documents in buckets
that still hold several are joined exactly on their rarest shingles, so that no link among them is left to chance.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from microbook.llm.common import stage, whole
from microbook.llm.shingles import U, mix, shingle_sets

BINS = 125
MISS = 5e-7  # two sets of the least similarity share no band at most so often, if bins agree independently
FINE_BANDS, FINE_ROWS = 128, 16  # for crowded buckets: all draw from the same bins, so 1 pair of similarity 0.85 in 73 is missed
CROWD = 3  # in a bucket of two the hub meets everyone
STRIP = 500  # documents of a shingle that meet all its others in one task of the exact join
WIDTH = 5
BROADCAST_IDS = 1_000_000  # ids sent to every task at most: 8 MB


def signatures(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """The least hash of each bin of each non-empty set, empty bins filled from others; one row per set."""
    values = np.zeros((len(sets), bins), np.uint64)
    filled = np.zeros((len(sets), bins), bool)
    for i, found in enumerate(sets):
        place = ((found >> U(32)) * U(bins)) >> U(32)  # rises with the hash, so the first of a bin is its least
        first = np.flatnonzero(np.diff(place, prepend=place[:1] + U(1)))
        values[i, place[first]] = found[first]
        filled[i, place[first]] = True
    row, col = np.nonzero(~filled)
    known = filled.copy()
    attempt = 0
    while row.size:
        attempt += 1
        source = (mix(col.astype(np.uint64) * U(0x9E3779B97F4A7C15) + U(attempt)) % U(bins)).astype(np.int64)
        ok = known[row, source]
        values[row[ok], col[ok]] = values[row[ok], source[ok]]
        row, col = row[~ok], col[~ok]
    return values


def band_keys(values: np.ndarray, bands: np.ndarray) -> np.ndarray:
    """A key for each band of each signature; a row of `bands` names its bins."""
    salt = U(bands.shape[1]) << U(32)
    keys = np.broadcast_to(np.arange(1, len(bands) + 1, dtype=np.uint64) + salt, (len(values), len(bands))).copy()
    for j in range(bands.shape[1]):
        keys = mix(keys * U(0xD6E8FEB86659FD93) + values[:, bands[:, j]])
    return keys.view(np.int64)


def coarse_bands(least: int) -> np.ndarray:
    """The longest bands that miss a pair of similarity `least` per cent once in 2 million: 25 of 5 bins for 85, 31 of 4 for 80."""
    for rows in range(16, 0, -1):
        bands = BINS // rows
        if rows == 1 or (1 - (least / 100) ** rows) ** bands <= MISS:
            return np.arange(bands * rows).reshape(bands, rows)


# drawn once: the bins of each fine band, without repetition inside a band
_draw = np.random.Generator(np.random.PCG64(85))
FINE = np.array([_draw.permutation(BINS)[:FINE_ROWS] for _ in range(FINE_BANDS)])


def sketched(docs: DataFrame, least: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, digest of the set, band keys (empty for an empty set), one row per input row."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("n_shingles", T.LongType()),
                           T.StructField("digest", T.BinaryType()), T.StructField("keys", T.ArrayType(T.LongType()))])

    coarse = coarse_bands(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets([t or "" for t in batch.column(1).to_pylist()], WIDTH))
            some = [s for s in sets if len(s)]
            keys = iter(band_keys(signatures(some, BINS), coarse).tolist()) if some else iter(())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                 pa.array([next(keys) if len(s) else [] for s in sets], pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "digest", "keys"])

    return rows.mapInArrow(run, schema)


def full_sets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and its shingle hashes."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets([t or "" for t in batch.column(1).to_pylist()], WIDTH))
            values = np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)
            offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
                                             ["doc_id", "shingles"])

    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], T.StructField("shingles", T.ArrayType(T.LongType()))]))


def buckets(placed: DataFrame) -> DataFrame:
    """key, node, n_shingles, n of the buckets that hold several nodes."""
    sizes = placed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    return stage(placed.join(sizes, "key"), "buckets")


def star_pairs(shared: DataFrame, least: int, picks: int = 1) -> DataFrame:
    """Candidate pairs (a, b): in each bucket every node with the bucket's hubs, one central and `picks` picked by hash, where
    their sizes allow a link."""
    weight = shared.groupBy("node").agg(F.sum("n").alias("weight"))
    ranked = shared.join(weight, "node")
    member = F.struct("node", "n_shingles")
    picked = [F.max(F.struct(F.xxhash64("node", "key", F.lit(i)).alias("h"), member.alias("hub"))).alias(f"p{i}") for i in range(picks)]
    hubs = ranked.groupBy("key").agg(F.max(F.struct("weight", member.alias("hub"))).alias("central"), *picked)
    names = ["central.hub", *[f"p{i}.hub" for i in range(picks)]]
    hubs = hubs.select("key", F.explode(F.array_distinct(F.array(*names))).alias("hub"))
    low, high = F.least("n_shingles", "hub.n_shingles"), F.greatest("n_shingles", "hub.n_shingles")
    return (shared.join(hubs, "key").where((F.col("node") != F.col("hub.node")) & (100 * low >= least * high))
            .select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")).distinct())


def sets_of(ids: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """node, shingles of the documents named in `ids` (node)."""
    ids = stage(ids, "shared-ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    sets = full_sets(rows.join(ids, rows["doc_id"] == ids["node"], "left_semi"))
    return stage(sets.withColumnRenamed("doc_id", "node"), "sets")


def confirmed(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """The pairs whose full sets reach the least similarity."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    shared = F.size(F.array_intersect("left", "right"))
    return (pairs.join(left, "a").join(right, "b")
            .where(100 * shared >= least * (F.size("left") + F.size("right") - shared)).select("a", "b").distinct())


def unsettled(shared: DataFrame, found: DataFrame) -> DataFrame:
    """node, component of the documents in crowded buckets with several components; `found` (node, component) are those so far."""
    crowd = shared.where(F.col("n") >= CROWD).select("key", "node").join(found, "node", "left")
    crowd = crowd.select("key", "node", F.coalesce("component", "node").alias("component"))
    open_ = crowd.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key")
    return stage(crowd.join(open_, "key", "left_semi").select("node", "component").distinct(), "unsettled")


def exact_links(nodes: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """All links between documents of different components in `nodes` (node, component).

    With shingles in the order of their frequency, the first that a linked pair shares is among the first n - ceil(least n) + 1 of
    both, and leaves enough behind it in both for the overlap. Shingles of many documents are cut into strips by a salt. A node
    that stands on several texts has several sets.
    """
    own = sets.join(nodes, "node").withColumn("set", F.xxhash64("shingles")).dropDuplicates(["node", "set"])
    rows = own.select("node", "set", "component", F.size("shingles").cast("bigint").alias("n"), F.posexplode("shingles").alias("i", "x"))
    known = rows.groupBy("x").agg(F.count("*").alias("df"))
    rank = F.row_number().over(Window.partitionBy("node", "set").orderBy("df", "x")) - 1
    ordered = rows.drop("i").join(known, "x").withColumn("i", rank)
    prefix = ordered.where((F.col("df") > 1) & (100 * (F.col("n") - F.col("i")) >= least * F.col("n"))).drop("df")
    held = prefix.groupBy("x").agg(F.ceil(F.count("*") / STRIP).alias("cuts")).withColumnRenamed("x", "of")
    cut = F.pmod(F.xxhash64("node", "x"), F.col("cuts"))
    placed = stage(prefix.join(held, prefix["x"] == held["of"]).withColumn("cut", cut).drop("of"), "prefixes")
    left = placed.select("x", "cut", *[F.col(c).alias(f"{c}_a") for c in ("node", "component", "n", "i")])
    right = placed.withColumn("cut", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("cuts") - 1)))
    right = right.select("x", "cut", *[F.col(c).alias(f"{c}_b") for c in ("node", "component", "n", "i")])
    both = F.least(F.col("n_a") - F.col("i_a"), F.col("n_b") - F.col("i_b"))
    pairs = left.join(right, ["x", "cut"]).where(
        (F.col("node_a") < F.col("node_b")) & (F.col("component_a") != F.col("component_b"))
        & ((100 + least) * both >= least * (F.col("n_a") + F.col("n_b"))))
    return confirmed(pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct(), sets, least)


def fine_links(shared: DataFrame, sets: DataFrame, found: DataFrame, least: int) -> DataFrame:
    """Links in crowded buckets between documents that no hub has joined: the same stars on 128 bands of 16 bins.

    `found` (node, component) are the components so far. Only nodes of buckets with several components take part.
    """
    nodes = unsettled(shared, found).select("node")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.array(s, np.int64).view(np.uint64) for s in batch.column(1).to_pylist()]
            some = [i for i, s in enumerate(rows) if len(s)]
            if not some:
                continue
            keys = band_keys(signatures([np.sort(rows[i]) for i in some], BINS), FINE)
            each = pa.array(np.repeat(some, FINE_BANDS))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), batch.column(0).take(each), pa.array(np.repeat([len(rows[i]) for i in some], FINE_BANDS))],
                ["key", "node", "n_shingles"])

    schema = T.StructType([T.StructField("key", T.LongType()), sets.schema["node"], T.StructField("n_shingles", T.LongType())])
    fine = buckets(sets.join(nodes, "node", "left_semi").select("node", "shingles").mapInArrow(keyed, schema).distinct())
    a = found.select(F.col("node").alias("a"), F.col("component").alias("of_a"))
    b = found.select(F.col("node").alias("b"), F.col("component").alias("of_b"))
    pairs = star_pairs(fine, least, picks=3).join(a, "a", "left").join(b, "b", "left").where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b"))
    return confirmed(pairs.select("a", "b"), sets, least)


def components(links: DataFrame) -> DataFrame:
    """node, component (the least node that its links reach) of every node that has a link.

    Alternating stars: each node sends its larger neighbours, then its smaller ones, to the least of them, until nothing moves.
    The number of rounds grows with the logarithm of a component; a node with many links is aggregated before it is joined.
    """
    edges = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = state
        ways = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = ways.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        edges = stage(small.where("u <> v").distinct(), "links")


def grouped(docs: DataFrame, least: int = 85, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept, one row per input row; `least` is the least similarity in per cent.

    Null and empty texts have no shingles and are linked with nothing. Equal sets are one node, named by their smallest doc_id;
    rows that repeat a doc_id are the same document whatever their texts. A row with a null doc_id stays alone and kept.
    """
    found = stage(sketched(docs, least, doc_id, text), "sketches")
    full = found.where("n_shingles > 0 and doc_id is not null")
    nodes = stage(full.groupBy("digest", "n_shingles", "keys").agg(F.min("doc_id").alias("node")), "nodes")
    shared = buckets(nodes.select(F.explode("keys").alias("key"), "node", "n_shingles"))
    sets = sets_of(shared.select("node").distinct(), docs, doc_id, text)
    first = components(confirmed(star_pairs(shared, least), sets, least).union(_same_document(full, nodes)))
    more = fine_links(shared, sets, first, least)
    second = components(first.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))
    rest = exact_links(unsettled(shared, second), sets, least)
    last = components(second.select(F.col("node").alias("a"), F.col("component").alias("b")).union(rest))
    named = nodes.select("digest", "node").join(last, "node", "left").select(
        F.col("digest").alias("set"), F.coalesce("component", "node").alias("component"))
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    joined = found.drop("keys").join(named, (found["digest"] == named["set"]) & ~alone, "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")).select(
        "*", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _same_document(full: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links between the nodes of a doc_id that stands on rows of different texts."""
    several = full.groupBy("doc_id").agg(F.min("digest").alias("x"), F.max("digest").alias("y")).where("x <> y").select("doc_id")
    of = full.select("doc_id", "digest").join(several, "doc_id").join(nodes.select("digest", "node"), "digest").select("doc_id", "node")
    least = of.groupBy("doc_id").agg(F.min("node").alias("b"))
    return of.join(least, "doc_id").select(F.col("node").alias("a"), "b").where("a <> b").distinct()


def kept(docs: DataFrame, least: int = 85, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, all their columns: one of each component, the one with the smallest doc_id, once.

    Rows without a doc_id stay all. Of rows that repeat a kept doc_id one stays, the one with the least text (null as empty), then
    the least hash of all its columns.
    """
    stay = grouped(docs, least, doc_id, text).where("kept and doc_id is not null").select(F.col("doc_id").alias("_llm_stays")).distinct()
    named, nameless = docs.where(F.col(doc_id).isNotNull()), docs.where(F.col(doc_id).isNull())
    one = Window.partitionBy(doc_id).orderBy(whole(text), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    first = named.join(stay, named[doc_id] == stay["_llm_stays"], "left_semi").withColumn("_llm_place", F.row_number().over(one))
    return first.where("_llm_place = 1").drop("_llm_place").union(nameless)
