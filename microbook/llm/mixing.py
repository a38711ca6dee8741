"""Mixing sources to target weights by Pfair scheduling.

Time is slots of one block each. Block k of a source of weight w (a share of one) is released at slot floor((k-1) / w) and due
before ceil(k / w); in each slot the released block that is due first goes. Since the shares add up to one, every block meets its
window, and at any slot a source is less than one block off its weight for as long as all sources have blocks left. Weights are
exact fractions, so this holds for any number of slots and sources. The driver computes the schedule from the sources' counts:
one step a block, a heap of the sources, and a part of the blocks in memory.
"""

from __future__ import annotations

import heapq
import itertools
import math
import uuid
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from microbook.llm.common import stage, stored, whole
from microbook.session import shared_dir

BLOCK = 16  # documents
SLOTS = 500_000  # blocks of the schedule that the driver holds at a time
BUCKET_ROWS = 50_000  # documents that are ranked together
LEAST_BUCKETS = 256  # so that a source with a third of the rows is ranked in many tasks
SCHEDULE = "microbook.schedule"  # metadata of a doc_id column: the folder with the places of its documents
SMALL_ROWS = 200_000  # rows of a table of bucket offsets or blocks that are sent to every task, at most: 5 to 8 MB


def identity(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A hash of a document by which its place is found again."""
    return F.xxhash64(F.col(doc_id), whole(text))


def exact_weights(counts: list[tuple[str | None, int]], weights: dict[str, float] | None) -> list[int]:
    """Whole numbers in the proportion of the sources' weights, without rounding; sources not named weigh as the least named.

    Without weights a source weighs as the square root of its documents.
    """
    if weights:
        least = min(weights.values())
        exact = [Fraction(weights.get(s, least) if s is not None else least) for s, _ in counts]
    else:
        exact = [Fraction(math.sqrt(n)) for _, n in counts]
    grain = math.lcm(*[w.denominator for w in exact])
    return [int(w * grain) for w in exact]


def slots_of(blocks: list[int], weights: list[int]) -> Iterator[tuple[int, int, int, int, int]]:
    """Source, block (from 0), release, deadline and slot of every block, by slot: of the released blocks the one due first.

    Windows follow from the weight and the number of the block alone. Slots that only blocks of run-out sources could have are
    passed over. Sources of weight 0 follow when the others have run out.
    """
    total = sum(weights)
    waiting = [(0, i, 0) for i, n in enumerate(blocks) if n and weights[i]]  # release, source, block: sorted, so a heap
    ready: list[tuple[int, int, int, int]] = []  # deadline, source, block, release
    slot = 0
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            release, i, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(k + 1) * total // weights[i]), i, k, release))
        due, i, k, release = heapq.heappop(ready)
        yield i, k, release, due, slot
        slot += 1
        if k + 1 < blocks[i]:
            heapq.heappush(waiting, ((k + 1) * total // weights[i], i, k + 1))
    for i, n in enumerate(blocks):
        for k in range(n if weights[i] else 0, n):
            yield i, k, slot, slot + 1, slot
            slot += 1


def schedule_of(counts: DataFrame, weights: dict[str, float] | None, block: int, slots: int) -> DataFrame:
    """source, k, release, deadline, slot of every block; `slots` blocks are held and handed to Spark at a time."""
    spark = counts.sparkSession
    found = [tuple(r) for r in counts.select("source", "n").collect()]
    path = f"{shared_dir(spark)}/blocks-{uuid.uuid4().hex}"
    names = ["k", "release", "deadline", "slot"]
    schema = T.StructType([T.StructField("source", counts.schema["source"].dataType), *[T.StructField(c, T.LongType()) for c in names]])
    made = slots_of([-(-n // block) for _, n in found], exact_weights(found, weights) if found else [])
    spark.createDataFrame([], schema).write.parquet(path)
    while part := list(itertools.islice(made, slots)):
        i, *columns = zip(*part)
        arrays = [pa.array([found[x][0] for x in i], to_arrow_type(schema["source"].dataType)), *[pa.array(c, pa.int64()) for c in columns]]
        spark.createDataFrame(pa.table(arrays, names=["source", *names]), schema).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def scheduled(docs: DataFrame, weights: dict[str, float] | None = None, block: int = BLOCK, slots: int = SLOTS,
              source: str = "source", doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """doc_id, source, _llm columns: hash, block (from 1), place in it, release, deadline, slot; and the columns named in `keep`.

    Documents of a source come in the order of a hash, numbered by counts of hash buckets, so no task ranks a whole source. Every
    row gets a slot: once a source has no block left its slots stay empty and the others go on in their windows. A null source is
    a source. Equal rows are in any order among themselves.
    """
    keep = keep or []
    rows = docs.select(F.col(doc_id).alias("_llm_id"), F.col(source).alias("_llm_source"), identity(doc_id, text).alias("_llm_hash"),
                       F.struct(*[F.col(c) for c in keep] or [F.lit(None).alias("none")]).alias("_llm_keep"))
    total = rows.count()
    buckets = max(LEAST_BUCKETS, -(-total // BUCKET_ROWS))
    placed = rows.withColumn("_llm_bucket", F.shiftrightunsigned("_llm_hash", 1) % buckets)
    counts = stage(placed.groupBy("_llm_source", "_llm_bucket").agg(F.count("*").alias("n")), "source-counts")
    before = Window.partitionBy("_llm_source").orderBy("_llm_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("_llm_source").alias("s"), F.col("_llm_bucket").alias("b"),
                            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    sources = counts.groupBy(F.col("_llm_source").alias("source")).agg(F.sum("n").alias("n"))
    planned = schedule_of(sources, weights, block, slots)
    if offsets.count() <= SMALL_ROWS:
        offsets = F.broadcast(offsets)
    if planned.count() <= SMALL_ROWS:
        planned = F.broadcast(planned)
    within = Window.partitionBy("_llm_source", "_llm_bucket").orderBy("_llm_hash", "_llm_id")
    ranked = placed.withColumn("_llm_rank", F.row_number().over(within))
    joined = ranked.join(offsets, ranked["_llm_source"].eqNullSafe(offsets["s"]) & (ranked["_llm_bucket"] == offsets["b"]))
    n = F.col("offset") + F.col("_llm_rank") - 1
    found = joined.select("*", F.floor(n / block).alias("_llm_k"), (n % block).alias("_llm_place"))
    found = found.join(planned, found["_llm_source"].eqNullSafe(planned["source"]) & (found["_llm_k"] == planned["k"]))
    return found.select(
        F.col("_llm_id"), F.col("_llm_source"), F.col("_llm_hash"), (F.col("_llm_k") + 1).alias("_llm_block"), "_llm_place",
        F.col("release").alias("_llm_release"), F.col("deadline").alias("_llm_deadline"), F.col("slot").alias("_llm_slot"),
        *[F.col("_llm_keep")[c].alias(c) for c in keep])


def order(docs: DataFrame, weights: dict[str, float] | None = None, block: int = BLOCK, slots: int = SLOTS, **names: str) -> DataFrame:
    """doc_id, source, block, place, release, deadline, slot, one row per input row."""
    found = scheduled(docs, weights, block, slots, **names)
    return found.select(*[F.col(f"_llm_{c}").alias(n) for c, n in (
        ("id", "doc_id"), ("source", "source"), ("block", "block"), ("place", "place"), ("release", "release"),
        ("deadline", "deadline"), ("slot", "slot"))])


def mixed(docs: DataFrame, weights: dict[str, float] | None = None, block: int = BLOCK, slots: int = SLOTS) -> DataFrame:
    """All documents and columns in the order of the schedule: written files follow each other in slots.

    Readers of the files need not keep that order, so the places are stored too; the metadata of doc_id names their folder, goes
    with the column through Parquet, and is read by `with_places`.
    """
    places = scheduled(docs, weights, block, slots).select("_llm_id", "_llm_hash", "_llm_block", "_llm_slot", "_llm_place")
    path = stored(places, "schedule")
    found = scheduled(docs, weights, block, slots, keep=docs.columns)
    found = (found.repartitionByRange("_llm_slot", "_llm_source", "_llm_place").sortWithinPartitions("_llm_slot", "_llm_source", "_llm_place")
             .select(*docs.columns))
    return found.withMetadata("doc_id", {**docs.schema["doc_id"].metadata, SCHEDULE: path})


def with_places(rows: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    """`rows` with block, slot and place of each document instead of its `identity` in the column `key`.

    They come from the schedule that `mixed` stored for `docs`, and are null where the documents were never mixed. Rows of the
    same document get one place each.
    """
    names = ("block", "slot", "place")
    path = docs.schema["doc_id"].metadata.get(SCHEDULE)
    if path is None:
        return rows.drop(key).withColumns({c: F.lit(None).cast("bigint") for c in names})
    places = rows.sparkSession.read.parquet(path)
    numbered = rows.withColumn("_llm_n", F.row_number().over(Window.partitionBy(key).orderBy("doc_id")))
    again = Window.partitionBy("_llm_hash").orderBy("_llm_id", "_llm_slot", "_llm_place")
    places = places.select("_llm_hash", F.row_number().over(again).alias("_llm_m"), *[F.col(f"_llm_{c}").alias(c) for c in names])
    joined = numbered.join(places, (numbered[key] == places["_llm_hash"]) & (numbered["_llm_n"] == places["_llm_m"]), "left")
    return joined.select(*[c for c in rows.columns if c != key], *names)
