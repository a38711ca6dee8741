"""Near-duplicate embeddings by cross-polytope hashing.

A hash rotates the unit vector at random (three rounds of sign flips and a fast Hadamard transform) and takes the nearest of the
2d signed axes; a table joins `depth` of them to one cell. A vector lives in one cell of each table and also visits the cells it
nearly fell into (multiprobe), so a pair meets where one lives and the other lives or visits. How often a pair at the threshold
meets in a table depends on its cosine and the dimension alone: it is measured on random pairs, and gives the number of tables.

Pairs are never written out. Large buckets are cut into strips; a task multiplies two strips, counts a pair only in the first
bucket in which it meets, and gives the number of links of each vector and a spanning star of each linked set.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from microbook.llm.common import stage
from microbook.llm.minhash import components

LEAST = 0.98
MISS = 1e-6  # a pair at the threshold meets in no table at most so often, if tables miss independently
TOGETHER = 0.9995  # share of the measured pairs that the tables find together
PROBES = 4  # cells of a table in which a vector is looked for, its own among them
AXES = 3  # axes of a rotation that a probe may choose from
CELL = 1 / 16  # vectors of a random cell at most, on the average: chooses the depth, so that unrelated vectors seldom meet
STRIP = 2048  # vectors of a bucket that meet in one task with as many others
CHOICES = 729  # combinations of axes among which a table's probes are chosen, at most: bounds the depth in few dimensions
LEAST_SIZE = 32
TRIALS = 4096  # random pairs that measure a table
SEED = 1307


def padded(d: int) -> int:
    """Length of the rotated vectors; sign flips and transforms of a few components would give a few rotations only."""
    return 1 << max(d - 1, LEAST_SIZE - 1).bit_length()


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Hadamard transform of the last axis, whose length is a power of two; in place, orthogonal."""
    d, h = x.shape[-1], 1
    while h < d:
        pairs = x.reshape(*x.shape[:-1], d // (2 * h), 2, h)
        left = pairs[..., 0, :].copy()
        pairs[..., 0, :] += pairs[..., 1, :]
        np.subtract(left, pairs[..., 1, :], out=pairs[..., 1, :])
        h *= 2
    x /= math.sqrt(d)
    return x


class Hashes:
    """Cells of `tables` tables of `depth` rotations each, for vectors of one dimension."""

    def __init__(self, d: int, tables: int, depth: int, probes: int = PROBES, seed: int = SEED) -> None:
        self.d, self.size, self.tables, self.depth = d, padded(d), tables, depth
        self.axes = min(AXES, self.size)
        self.probes = min(probes, self.axes ** depth)
        draw = np.random.Generator(np.random.PCG64([seed, d]))
        # drawn table by table, so that more tables begin with the same ones
        self.signs = np.stack([np.where(draw.random((depth, 3, self.size)) < 0.5, -1.0, 1.0) for _ in range(tables)])
        self.choices = np.stack(np.meshgrid(*[np.arange(self.axes)] * depth, indexing="ij"), -1).reshape(-1, depth)

    def cells(self, unit: np.ndarray) -> np.ndarray:
        """(rows, tables, probes) numbers of cells, the own cell first, then by what a probe loses."""
        out = np.empty((len(unit), self.tables, self.probes), np.int64)
        wide = np.zeros((len(unit), self.size))
        wide[:, :self.d] = unit
        for t in range(self.tables):
            x = np.repeat(wide[:, None, :], self.depth, 1)
            for turn in range(3):
                x = hadamard(x * self.signs[t, :, turn])
            size = np.abs(x)
            top = np.argpartition(-size, min(self.axes, self.size - 1), -1)[..., :self.axes] if self.axes < self.size else np.argsort(-size, -1)
            kept = np.take_along_axis(size, top, -1)
            order = np.argsort(-kept, -1, kind="stable")
            top, kept = np.take_along_axis(top, order, -1), np.take_along_axis(kept, order, -1)
            axis = 2 * top + (np.take_along_axis(x, top, -1) < 0)  # (rows, depth, axes)
            loss = (kept[..., :1] - kept) ** 2
            total = sum(loss[:, j, self.choices[:, j]] for j in range(self.depth))  # (rows, choices)
            best = np.argsort(total, 1, kind="stable")[:, :self.probes]
            number = np.zeros(best.shape, np.int64)
            for j in range(self.depth):
                number = number * (2 * self.size) + np.take_along_axis(axis[:, j], self.choices[best, j], 1)
            out[:, t] = number
        return out


def meeting(d: int, depth: int, least: float = LEAST, probes: int = PROBES, tables: int = 1) -> float:
    """How often a pair at the threshold meets in one of the tables, measured on random pairs."""
    draw = np.random.Generator(np.random.PCG64([SEED, d, depth]))
    a = draw.standard_normal((TRIALS, d))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = draw.standard_normal((TRIALS, d))
    b -= (a * b).sum(1)[:, None] * a
    length = np.linalg.norm(b, axis=1)[:, None]
    b = least * a + math.sqrt(1 - least * least) * np.divide(b, length, out=np.zeros_like(b), where=length > 0)
    hashes = Hashes(d, tables, depth, probes)
    x, y = hashes.cells(a), hashes.cells(b)
    return float(((x[..., :1] == y).any(2) | (y[..., :1] == x).any(2)).any(1).mean())


def plan(d: int, rows: int, least: float = LEAST, miss: float = MISS, probes: int = PROBES) -> tuple[int, int]:
    """(depth, tables): deep enough for cells of `CELL` vectors, tables enough for `miss`. Recall is the same at every size.

    In few dimensions vectors are near each other however fine the cells; the depth ends where a table still meets half the pairs.
    """
    depth = max(1, math.ceil(math.log(max(rows / CELL, 1)) / math.log(2 * padded(d)))) if d > 1 else 1
    while depth > 1 and (min(AXES, padded(d)) ** depth > CHOICES or meeting(d, depth, least, probes) < 0.5):
        depth -= 1
    hit = min(meeting(d, depth, least, probes), 1 - 1 / TRIALS)
    if hit <= 0:
        raise ValueError("pairs of a cosine this low meet in no cell")
    tables = max(1, math.ceil(math.log(miss) / math.log(1 - hit)))
    while meeting(d, depth, least, probes, tables) < TOGETHER and tables < 200:  # tables that depend on each other
        tables += 2
    return depth, tables


def unit(x: np.ndarray) -> np.ndarray | None:
    """The vector's direction in double precision; None for an empty or zero vector, or one with a non-finite component."""
    x = x.astype(np.float64)
    most = np.abs(x).max(initial=0.0)
    if not np.isfinite(most) or not most:
        return None
    x = x / most  # no overflow in the squares
    return x / math.sqrt(x @ x)


def _units(column: pa.Array) -> list[np.ndarray | None]:
    return [unit(v.values.to_numpy(zero_copy_only=False)) if v.is_valid and not v.values.null_count else None for v in column]


def _identity(label: object, unit: np.ndarray) -> bytes:
    return hashlib.sha256(f"{label}:{len(unit)}:".encode() + (unit + 0.0).tobytes()).digest()


def vectors(rows: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """vec_id, label, identity (of label and direction; null if the vector links with nothing), x (the vector), d, one row per input row."""
    kind = rows.schema[embedding].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    given = rows.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"),
                        F.col(embedding).cast("array<float>" if single else "array<double>").alias("x"))
    schema = T.StructType([given.schema["vec_id"], given.schema["label"], T.StructField("identity", T.BinaryType()),
                           given.schema["x"], T.StructField("d", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, units = batch.column(1).to_pylist(), _units(batch.column(2))
            told = [None if u is None or label is None else _identity(label, u) for u, label in zip(units, labels)]
            sizes = [None if i is None else len(u) for i, u in zip(told, units)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(told, pa.binary()), batch.column(2), pa.array(sizes, pa.int32())],
                                             [f.name for f in schema])

    return given.mapInArrow(run, schema)


def placed(nodes: DataFrame, plans: dict[int, tuple[int, int]], probes: int) -> DataFrame:
    """The nodes with `keys`: for each table the own cell and the visited ones, mixed with label, dimension and table."""
    schema = T.StructType([*[nodes.schema[c] for c in ("node", "copies", "x")], T.StructField("keys", T.ArrayType(T.LongType()))])
    rows = nodes.select("node", "copies", "x", F.xxhash64("label", "d").alias("salt"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, Hashes] = {}
        for batch in batches:
            salts = batch.column(3).to_numpy()
            units = _units(batch.column(2))
            sizes = np.array([len(u) for u in units])
            keys: list = [None] * len(units)
            for d in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == d)
                depth, tables = plans[d]
                hashes = made.setdefault(d, Hashes(d, tables, depth, probes))
                for part in np.array_split(at, -(-len(at) * d // 262_144)):
                    cells = hashes.cells(np.stack([units[i] for i in part])).astype(np.uint64)
                    tags = np.arange(1, tables + 1, dtype=np.uint64)[None, :, None] * np.uint64(0x9E3779B97F4A7C15)
                    mixed = _mix(_mix(cells + tags) ^ salts[part].astype(np.int64).view(np.uint64)[:, None, None]).view(np.int64)
                    for i, row in zip(part.tolist(), mixed.reshape(len(part), -1).tolist()):
                        keys[i] = row
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(keys, pa.list_(pa.int64()))], [f.name for f in schema])

    return rows.mapInArrow(run, schema)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buckets(found: DataFrame, probes: int, strip: int) -> DataFrame:
    """key, place (index of the key among the node's keys), low and high strip, and the node's columns, for every two strips of
    every bucket in which some pair meets."""
    cells = found.select("node", F.posexplode("keys").alias("place", "key"))
    own = (F.col("place") % probes == 0)
    sizes = cells.groupBy("key").agg(F.count("*").alias("n"), F.count(F.when(own, 1)).alias("own"))
    sizes = stage(sizes.where("n > 1 and own > 0").select(F.col("key").alias("of"), F.ceil(F.col("n") / strip).cast("int").alias("cuts")), "cells")
    used = cells.join(sizes, cells["key"] == sizes["of"]).groupBy("node").agg(F.collect_list(F.struct("key", "place", "cuts")).alias("used"))
    used = stage(used.withColumnRenamed("node", "user"), "used")
    rows = found.join(used, found["node"] == used["user"]).withColumn("at", F.explode("used"))
    rows = rows.select("node", "copies", "x", "keys", "at.key", "at.place", "at.cuts")
    own_strip = F.pmod(F.xxhash64("node", "key"), F.col("cuts")).cast("int")
    rows = rows.withColumn("strip", own_strip).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    return rows.select("key", F.least("strip", "other").alias("low"), F.greatest("strip", "other").alias("high"), "strip", "place",
                       "node", "copies", "x", "keys")


class Strip:
    """The members of one strip of one bucket."""

    def __init__(self, rows: list) -> None:
        self.place, self.node, self.copies, given, self.keys = map(np.array, zip(*rows))
        wide = given.astype(np.float64)
        wide /= np.abs(wide).max(1)[:, None]
        self.unit = wide / np.sqrt((wide * wide).sum(1))[:, None]


def met_first(a: Strip, b: Strip, i: np.ndarray, j: np.ndarray, key: int, probes: int) -> np.ndarray:
    """Which of the pairs (i of a, j of b) meet in this bucket and in none before it; a bucket they meet in is the own cell of one."""
    left, right = a.place[i], b.place[j]
    table = left // probes
    ok = (left % probes == 0) | (right % probes == 0)
    i, j, at = i[ok], j[ok], np.flatnonzero(ok)
    first = np.ones(len(i), bool)
    for t in range(int(table[0]) + 1 if len(table) else 0):
        x, y = a.keys[i, t * probes:(t + 1) * probes], b.keys[j, t * probes:(t + 1) * probes]
        forth, back = (y == x[:, :1]).any(1), (x == y[:, :1]).any(1)
        if t < table[0]:
            first &= ~(forth | back)
        else:  # both may meet twice in a table, each in the other's cell: the smaller key counts
            here = np.where(forth & back, np.minimum(x[:, 0], y[:, 0]), np.where(forth, x[:, 0], y[:, 0]))
            first &= here == key
    out = np.zeros(len(ok), bool)
    out[at[first]] = True
    return out


def linked(a: Strip, b: Strip, same: bool, key: int, probes: int, least: float, part: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i of a, j of b) that reach the threshold and meet here first, by blocks of products."""
    left, right = [], []
    for x in range(0, len(a.node), part):
        for y in range(x if same else 0, len(b.node), part):
            i, j = np.nonzero(a.unit[x:x + part] @ b.unit[y:y + part].T >= least)
            i, j = i + x, j + y
            if same:
                i, j = i[i < j], j[i < j]
            ok = met_first(a, b, i, j, key, probes)
            left.append(i[ok].astype(np.int32))
            right.append(j[ok].astype(np.int32))
    return np.concatenate(left or [np.empty(0, np.int32)]), np.concatenate(right or [np.empty(0, np.int32)])


def stars(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For n members with links (i, j): the least member that each reaches."""
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        root = root[root]
        if (root == before).all():
            return root


def compared(found: DataFrame, probes: int, least: float, strip: int) -> DataFrame:
    """node, links (to other nodes' vectors, copies counted), peer: a node of its linked set in one pair of strips."""
    rows = buckets(found, probes, strip)
    rows = rows.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    schema = T.StructType([found.schema["node"], T.StructField("links", T.LongType()), T.StructField("peer", found.schema["node"].dataType)])

    def pair(key: int, low: int, high: int, members: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        one = [m[1:] for m in members if m[0] == low]
        two = [m[1:] for m in members if m[0] == high] if high != low else one
        if not one or not two or (one is two and len(one) == 1):
            return (np.empty(0, np.int64),) * 3
        a = Strip(one)
        b = Strip(two) if two is not one else a
        i, j = linked(a, b, two is one, key, probes, least)
        shift = 0 if two is one else len(a.node)
        nodes = a.node if two is one else np.concatenate([a.node, b.node])
        links = np.zeros(len(nodes), np.int64)
        np.add.at(links, i, b.copies[j])
        np.add.at(links, j + shift, a.copies[i])
        root = stars(len(nodes), i, j + shift)
        some = links > 0
        return nodes[some], links[some], nodes[root[some]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, members, out, held = None, [], [], 0

        def flush() -> pa.RecordBatch:
            columns = [np.concatenate(c).astype(np.int64) for c in zip(*out)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "links", "peer"])

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[:7]]
            given, keys = batch.column(7), batch.column(8)
            for k, (key, low, high, own, place, node, copies) in enumerate(zip(*columns)):
                if (key, low, high) != now:
                    if len(members) > 1:
                        out.append(pair(*now, members))
                        held += len(out[-1][0])
                    now, members = (key, low, high), []
                    if held > 10_000:
                        yield flush()
                        out, held = [], 0
                members.append((own, place, node, copies, given[k].values.to_numpy(), keys[k].values.to_numpy()))
        if len(members) > 1:
            out.append(pair(*now, members))
        if out:
            yield flush()

    return rows.mapInArrow(run, schema)


def grouped(rows: DataFrame, least: float = LEAST, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
            miss: float = MISS, probes: int = PROBES, strip: int = STRIP) -> DataFrame:
    """vec_id, n_links, component_id, kept, one row per input row; vectors are compared where labels are equal.

    A null, empty or zero vector, one with a null or non-finite component, and one without a label has no links. Vectors of
    different lengths are never linked. Vectors of one label and direction are one node that counts its copies, so a mass of
    copies costs one. Rows that repeat a vec_id stay rows of their own; a null vec_id names no component unless alone.
    """
    every = stage(vectors(rows, vec_id, embedding, label), "vectors")
    some = every.where("identity is not null")
    # nodes are numbered once, on a table that is written
    nodes = stage(some.groupBy("identity").agg(F.min("vec_id").alias("least_id"), F.count("*").alias("copies"), F.first("label").alias("label"),
                                               F.first("x").alias("x"), F.first("d").alias("d")), "copies")
    nodes = stage(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    sizes = nodes.groupBy("d", "label").count().groupBy("d").agg(F.max("count").alias("n")).orderBy(F.desc("n")).limit(1001).collect()
    if len(sizes) > 1000:
        raise ValueError("vectors of over 1000 different lengths")
    plans = {r["d"]: plan(r["d"], r["n"], least, miss, probes) for r in sizes}
    # a table may not have so many probes in one dimension; keys are laid out by the fewest
    probes = min([probes, *[min(AXES, padded(d)) ** depth for d, (depth, _) in plans.items()]])
    plans = {d: plan(d, next(r["n"] for r in sizes if r["d"] == d), least, miss, probes) for d in plans}
    found = stage(placed(nodes, plans, probes), "placed")
    parts = stage(compared(found, probes, least, strip), "links")
    links = parts.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(parts.where("node <> peer").select(F.col("node").alias("a"), F.col("peer").alias("b")))
    joined = joined.select(F.col("node").alias("member"), "component")
    named = nodes.select("node", "identity", "copies", "least_id").join(joined, F.col("node") == F.col("member"), "left")
    named = stage(named.select("node", "identity", "copies", "least_id", F.coalesce("component", "node").alias("component")), "named")
    ids = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    ids = ids.withColumnRenamed("component", "of")
    links = links.withColumnRenamed("node", "linked")
    named = named.join(ids, named["component"] == ids["of"]).join(links, named["node"] == links["linked"], "left").select(
        F.col("identity").alias("of_identity"), "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = every.select("vec_id", "identity").join(named, F.col("identity") == F.col("of_identity"), "left")
    component = F.when(F.col("identity").isNull(), F.col("vec_id")).otherwise(F.coalesce("component_id", "vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id")).select(
        "*", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
