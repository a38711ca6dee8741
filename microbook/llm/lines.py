"""Line dedup over an exact table of how many documents hold each line, fronted by sharded cuckoo filters.

The table (key, n_docs) is exact; documents are inserted by adding their counts and deleted by subtracting them, so dedup can be
undone. The filters hold the keys found in enough documents, in shards of bounded size, and follow the table by insertions and
deletions of single keys. A line that misses its filter is kept at once; a hit is settled by the exact table.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from microbook.llm.common import SPACES, stage

LEAST_DOCS = 10
SHARD_KEYS = 50_000  # keys in a shard's filter on average
EXACT_KEYS = 1_000_000  # frequent keys sent to every task beside the filters, at most: 16 MB
FILTER_KEYS = 20_000_000  # keys whose filters are sent to every task, at most: 80 MB
HELD = 300_000  # keys a task counts before it passes them on
SLOTS = 4
_SPACE_BYTES = SPACES.encode()


class CuckooFilter:
    """16-bit fingerprints in buckets of four, each at one of two buckets; supports deletion."""

    def __init__(self, keys: int = 0, slots: np.ndarray | None = None) -> None:
        size = 1 << max(2, math.ceil(math.log2(max(1, keys) / SLOTS / 0.8)))
        self.slots = np.zeros((size, SLOTS), np.uint16) if slots is None else slots

    @staticmethod
    def parts(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint and both buckets of 64-bit hashes."""
        prints = (hashes >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        first = (hashes & np.uint64(size - 1)).astype(np.int64)
        return prints, first, first ^ CuckooFilter.step(prints, size)

    @staticmethod
    def step(prints: np.ndarray, size: int) -> np.ndarray:
        return ((prints.astype(np.uint64) * np.uint64(0x5BD1E995)) >> np.uint64(7)).astype(np.int64) & (size - 1)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        prints, one, two = self.parts(hashes, len(self.slots))
        return (self.slots[one] == prints[:, None]).any(1) | (self.slots[two] == prints[:, None]).any(1)

    def insert(self, hashes: np.ndarray) -> bool:
        """Add each hash; false if a fingerprint found no place (the filter must then be built again, larger)."""
        size = len(self.slots)
        prints, one, two = self.parts(hashes, size)
        for print_, a, b in zip(prints.tolist(), one.tolist(), two.tolist()):
            for kick in range(500):
                placed = False
                for at in (a, b):
                    free = np.flatnonzero(self.slots[at] == 0)
                    if free.size:
                        self.slots[at, free[0]] = print_
                        placed = True
                        break
                if placed:
                    break
                slot = kick % SLOTS
                print_, self.slots[b, slot] = int(self.slots[b, slot]), print_
                a = b
                b = int(a ^ self.step(np.array([print_], np.uint16), size)[0])
            else:
                return False
        return True

    def delete(self, hashes: np.ndarray) -> None:
        """Remove one fingerprint of each hash; only for hashes that were inserted."""
        prints, one, two = self.parts(hashes, len(self.slots))
        for print_, a, b in zip(prints.tolist(), one.tolist(), two.tolist()):
            for at in (a, b):
                there = np.flatnonzero(self.slots[at] == print_)
                if there.size:
                    self.slots[at, there[0]] = 0
                    break

    @classmethod
    def of(cls, hashes: np.ndarray) -> CuckooFilter:
        room = max(1, len(hashes))
        while True:
            made = cls(room)
            if made.insert(hashes):
                return made
            room *= 2

    def pack(self) -> bytes:
        return self.slots.tobytes()

    @classmethod
    def unpack(cls, data: bytes) -> CuckooFilter:
        return cls(slots=np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy())


def keys_of(text: str) -> list[bytes | None]:
    """The key of each line: 128 bits of the stripped, A-Z lower-cased line; None for an empty key."""
    digest = xxhash.xxh3_128_digest
    stripped = [line.strip(_SPACE_BYTES) for line in text.encode("utf-8", "surrogatepass").lower().split(b"\n")]
    return [digest(s) if s else None for s in stripped]


def hashes_of(keys: list[bytes]) -> np.ndarray:
    """64 bits of each key for the filters; the other half chooses the shard."""
    return np.frombuffer(b"".join(keys), np.uint64)[0::2]


def shard_of(keys: list[bytes], shards: int) -> np.ndarray:
    return (np.frombuffer(b"".join(keys), np.uint64)[1::2] % np.uint64(shards)).astype(np.int64)


def counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """key, n_docs: in how many rows a line's key is found. Each task adds up its own rows first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def passed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                                              ["key", "n_docs"])

        for batch in batches:
            for t in batch.column(0):
                seen.update({k for k in keys_of(t.as_py() or "") if k is not None})
                if len(seen) > HELD:
                    yield passed()
                    seen.clear()
        if seen:
            yield passed()

    return (docs.select(F.col(text).alias("text")).mapInArrow(count, "key binary, n_docs bigint")
            .groupBy("key").agg(F.sum("n_docs").alias("n_docs")))


def inserted(table: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """The table after more documents."""
    return table.unionByName(counts(docs, text)).groupBy("key").agg(F.sum("n_docs").alias("n_docs"))


def deleted(table: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """The table after documents are taken out again; an error if one was never in it."""
    less = counts(docs, text).select("key", (-F.col("n_docs")).alias("n_docs"))
    left = table.unionByName(less).groupBy("key").agg(F.sum("n_docs").alias("n_docs"))
    left = left.withColumn("n_docs", F.when(F.col("n_docs") < 0, F.raise_error(F.lit("a deleted document was never inserted"))
                                            .cast("bigint")).otherwise(F.col("n_docs")))
    return left.where("n_docs <> 0")


def frequent(table: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    return table.where(F.col("n_docs") >= least).select("key")


def _with_shard(keys: DataFrame, shards: int) -> DataFrame:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = shard_of(batch.column(0).to_pylist(), shards) if batch.num_rows else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(shard), *batch.columns], ["shard", *batch.schema.names])

    return keys.mapInArrow(add, T.StructType([T.StructField("shard", T.LongType()), *keys.schema.fields]))


def filters(keys: DataFrame, shards: int) -> DataFrame:
    """shard, filter: a cuckoo filter of each shard's keys."""

    def build(shard: pd.DataFrame) -> pd.DataFrame:
        made = CuckooFilter.of(hashes_of(shard["key"].tolist()))
        return pd.DataFrame({"shard": [shard["shard"].iloc[0]], "filter": [made.pack()]})

    return _with_shard(keys.select("key"), shards).groupBy("shard").applyInPandas(build, "shard bigint, filter binary")


def updated(old: DataFrame, before: DataFrame, after: DataFrame, shards: int, least: int = LEAST_DOCS) -> DataFrame:
    """The filters after the table moved from `before` to `after`: only keys that crossed the threshold enter or leave."""
    b, a = frequent(before, least).withColumn("was", F.lit(True)), frequent(after, least).withColumn("stays", F.lit(True))
    moved = b.join(a, "key", "full").where("was is null or stays is null").select("key", F.col("was").isNull().alias("enters"))

    def change(was: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        filter_ = CuckooFilter.unpack(was["filter"].iloc[0]) if len(was) else CuckooFilter(len(keys))
        shard = (was if len(was) else keys)["shard"].iloc[0]
        gone, new = keys[~keys["enters"].astype(bool)]["key"].tolist(), keys[keys["enters"].astype(bool)]["key"].tolist()
        if gone:
            filter_.delete(hashes_of(gone))
        full = bool(new) and not filter_.insert(hashes_of(new))
        return pd.DataFrame({"shard": [shard], "filter": [filter_.pack()], "full": [full]})

    out = stage(old.groupBy("shard").cogroup(_with_shard(moved, shards).groupBy("shard"))
                .applyInPandas(change, "shard bigint, filter binary, full boolean"), "filters")
    full = out.where("full").select("shard")
    again = filters(_with_shard(frequent(after, least), shards).join(full, "shard", "left_semi").select("key"), shards)
    return out.where("not full").drop("full").unionByName(again)


class Screen:
    """The filters of all shards, in a task."""

    def __init__(self, packed: dict[int, bytes], shards: int) -> None:
        self.filters = {shard: CuckooFilter.unpack(data) for shard, data in packed.items()}
        self.shards = shards

    def hits(self, keys: list[bytes]) -> list[bytes]:
        if not keys:
            return []
        hashes, shard = hashes_of(keys), shard_of(keys, self.shards)
        hit = np.zeros(len(keys), bool)
        for s in np.unique(shard).tolist():
            if s in self.filters:
                at = np.flatnonzero(shard == s)
                hit[at] = self.filters[s].holds(hashes[at])
        return [keys[i] for i in np.flatnonzero(hit).tolist()]


class Index:
    """Frequent lines of a table of documents, and how to take them out of texts."""

    def __init__(self, table: DataFrame, least: int = LEAST_DOCS, exact_keys: int = EXACT_KEYS, filter_keys: int = FILTER_KEYS) -> None:
        self.keys = stage(frequent(table, least), "frequent-lines")
        self.n = self.keys.count()
        self.shards = max(1, -(-self.n // SHARD_KEYS))
        spark = table.sparkSession
        context = spark.sparkContext
        self.screen = self.exact = None
        if self.n <= filter_keys:
            rows = filters(self.keys, self.shards).toArrow()
            self.screen = context.broadcast(dict(zip(rows.column("shard").to_pylist(), rows.column("filter").to_pylist())))
        if self.n <= exact_keys:
            self.exact = context.broadcast(self.keys.toArrow().column("key").to_pylist())

    def cleaned(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """All columns of `docs` with frequent lines taken out of `text`, and _llm_lines, _llm_dropped (lines before, dropped).

        A null text has one empty line and stays null. A text may lose all its lines and is then empty; its row stays.
        """
        extra = [T.StructField("_llm_lines", T.LongType()), T.StructField("_llm_dropped", T.LongType())]
        schema = T.StructType([*docs.schema.fields, *extra])
        screen, exact, shards = self.screen, self.exact, self.shards
        place, wide_to = docs.columns.index(text), len(docs.columns)

        def finished(batch: pa.RecordBatch, bad_of) -> pa.RecordBatch:
            texts, n_lines, n_dropped = [], [], []
            for i, t in enumerate(batch.column(place)):
                one = t.as_py()
                keys = keys_of(one or "")
                bad = bad_of(i, keys)
                n_lines.append(len(keys))
                n_dropped.append(sum(k in bad for k in keys) if bad else 0)
                texts.append("\n".join([x for x, k in zip(one.split("\n"), keys) if k not in bad]) if bad and one else one)
            columns = list(batch.columns)[:wide_to]
            columns[place] = pa.array(texts, pa.string())
            return pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], schema.names)

        if exact is not None and screen is not None:
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                sieve, settled = Screen(screen.value, shards), set(exact.value)
                for batch in batches:
                    yield finished(batch, lambda _, keys: settled.intersection(sieve.hits([k for k in keys if k is not None])))

            return docs.mapInArrow(run, schema)

        row = T.StructField("_llm_row", T.LongType())
        wide = T.StructType([*docs.schema.fields, row, T.StructField("_llm_keys", T.ArrayType(T.BinaryType()))])

        def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sieve = Screen(screen.value, shards) if screen is not None else None
            at = TaskContext.get().partitionId() << 33
            for batch in batches:
                lists = [list({k for k in keys_of(t.as_py() or "") if k is not None}) for t in batch.column(place)]
                lists = [sieve.hits(x) for x in lists] if sieve else lists
                rows = pa.array(np.arange(at, at + batch.num_rows))
                at += batch.num_rows
                yield pa.RecordBatch.from_arrays([*batch.columns, rows, pa.array(lists, pa.list_(pa.binary()))], wide.names)

        def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bad = batch.column(wide_to).to_pylist()
                yield finished(batch, lambda i, _: set(bad[i] or ()))

        held = stage(docs.mapInArrow(keyed, wide), "keyed-documents")
        bad = (held.select("_llm_row", F.explode("_llm_keys").alias("key")).join(self.keys, "key")
               .groupBy("_llm_row").agg(F.collect_list("key").alias("_llm_bad")))
        return held.drop("_llm_keys").join(bad, "_llm_row", "left").select(*docs.columns, "_llm_bad").mapInArrow(drop, schema)


def digests(docs: DataFrame, least: int = LEAST_DOCS, doc_id: str = "doc_id", text: str = "text", **bounds: int) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256, one row per input row.

    Each row counts as a document of its own, repeated ids too. Null and empty texts are one empty line, which is never dropped.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    out = Index(counts(rows), least, **bounds).cleaned(rows)
    return out.select("doc_id", F.col("_llm_lines").alias("n_lines"), F.col("_llm_dropped").alias("n_dropped"),
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def cleaned(docs: DataFrame, least: int = LEAST_DOCS, text: str = "text") -> DataFrame:
    """The documents without the lines that `least` of them or more share; n_chars, where it is a column, follows."""
    out = Index(counts(docs, text), least).cleaned(docs, text).drop("_llm_lines", "_llm_dropped")
    return out.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
