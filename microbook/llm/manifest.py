"""A Merkle manifest with a witness for every document.

Leaves are digests of documents. In each group they ascend by id; every 8 consecutive nodes become one node until one is left,
the group's root, and the groups' roots become the root of all in the same way.

Leaves are cut into aligned blocks of 8^k, so a block is a whole subtree and its root one node k levels up. A task reads the
leaves of a block in order and appends them to a frontier of open subtrees. An appended node gets a partial witness, the nodes
to its left in its run; each later sibling that completes extends it on the right. All leaves below share the witness of their
subtree. Block roots are then further appends: they are the leaves of the next round, whose witnesses continue those below.
"""

from __future__ import annotations

import hashlib
from binascii import hexlify
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from microbook.llm.common import stage
from microbook.session import BROADCAST_ROWS

BITS = 3  # a run has 8 nodes
RUN = 1 << BITS
BLOCK_LEVELS = 3  # a block has 512 leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED = 3  # documents whose crc32 this divides are tampered with in the test of the manifest


def node_hash(nodes: bytes) -> bytes:
    """Digest of nodes written as hexadecimal text, one after the other."""
    return hashlib.sha256(hexlify(nodes)).digest()


def height(n: int) -> int:
    """Levels above n leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // RUN), levels + 1
    return levels


class Frontier:
    """Open subtrees of one block, appended to in order.

    `append` takes a leaf's digest and an item of the caller's; `finish` closes what is open. Both return the items of runs that
    are complete, each as (items, leaves, path): `path` is the list of [left, right] siblings of every level above the run. It is
    whole only after `finish`, which also sets `root`.
    """

    def __init__(self, levels: int) -> None:
        self.levels = levels
        self.open: list[list[tuple[bytes, list, list]]] = [[] for _ in range(levels + 1)]
        self.items: list = []
        self.done: list[tuple[list, list[bytes], list]] = []
        self.root = b""

    def append(self, digest: bytes, item: object) -> None:
        self.items.append(item)
        self._push(0, digest, [])

    def _push(self, level: int, digest: bytes, paths: list[list]) -> None:
        if level == self.levels:
            self.root = digest
            if not level:  # a lone leaf is its own root
                self.done.append((self.items, [digest], []))
            return
        run = self.open[level]
        # the new node's witness so far is what stands to its left; it extends the witness of each of those
        witness = [b"".join([node for node, _, _ in run]), bytearray()]
        for _, _, earlier in run:
            earlier[1] += digest
        for path in paths:
            path.append(witness)
        run.append((digest, paths, witness))
        if len(run) == RUN:
            self._close(level)

    def _close(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        nodes = [node for node, _, _ in run]
        if level:
            paths = [path for _, below, _ in run for path in below]
        else:
            paths = [[]]
            self.done.append((self.items, nodes, paths[0]))
            self.items = []
        self._push(level + 1, node_hash(b"".join(nodes)), paths)

    def finish(self) -> list[tuple[list, list[bytes], list]]:
        for level in range(self.levels):
            if self.open[level]:
                self._close(level)
        return self.done


def leaf(*columns: Column) -> Column:
    """Digest of a document: each field as its UTF-8 byte count, a colon and its value; `-` if it is null."""
    parts = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def leaves(docs: DataFrame, group: str, fields: tuple[str, ...], doc_id: str, changed: dict[str, Column] | None) -> DataFrame:
    """doc_id, group key, leaf, and `shown`, the leaf of the document as it is now (`changed` gives columns that differ)."""
    now = [(changed or {}).get(name, F.col(name)) for name in fields]
    # null first, then by bytes: the same order as a string that is never null
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), key.alias("key"), leaf(*map(F.col, fields)).alias("leaf"), leaf(*now).alias("shown"))
    return stage(rows, "leaves")


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """`rows` with their rank in their key by `order` and the key's count n.

    Rows are dealt to tasks by ranges of (key, order) and sorted there; a key's rows before a task follow from one count a task
    and key. Many equal rows are dealt to several tasks; it does not matter which of
    them comes first.
    """
    dealt = rows.withColumn("at", F.monotonically_increasing_id()).repartitionByRange("key", *order, "at")
    placed = stage(dealt.sortWithinPartitions("key", *order).withColumn("at", F.monotonically_increasing_id()), "ordered")
    task = F.shiftright("at", 33)
    cells = placed.groupBy("key", task.alias("task")).agg(F.count("*").alias("here"), F.min("at").alias("first"))
    before = Window.partitionBy("key").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(F.col("key").alias("of"), F.col("task").alias("in_task"), F.coalesce(F.sum("here").over(before), F.lit(0)).alias("off"), "first",
                         F.sum("here").over(Window.partitionBy("key")).alias("n"))
    cells = stage(cells, "cells")
    if cells.count() <= BROADCAST_ROWS:
        cells = F.broadcast(cells)
    joined = placed.join(cells, (placed["key"] == cells["of"]) & (task == cells["in_task"]))
    return joined.select(*rows.columns, (F.col("off") + F.col("at") - F.col("first")).alias("rank"), "n")


PATH = T.ArrayType(T.BinaryType())  # left and right siblings of each level, from below: [left, right, left, right, ...]
A_PATH = pa.list_(pa.binary())


def _flat(path: list) -> list[bytes]:
    return [bytes(side) for pair in path for side in pair]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Frontier]]:
    """The finished frontier of each block: rows are (key, rank, n, digest, block, levels, item) in order."""
    now, frontier = None, None
    for batch in batches:
        for key, rank, n, digest, block, levels, item in zip(*[c.to_pylist() for c in batch.columns]):
            if (key, block) != now:
                if frontier is not None:
                    yield (*now, held), frontier
                now, held, frontier = (key, block), n, Frontier(min(levels, height(n)))
            frontier.append(digest, (rank, item))
    if frontier is not None:
        yield (*now, held), frontier


def _in_blocks(nodes: DataFrame, levels: int) -> DataFrame:
    """The nodes of each block together and in order."""
    block = F.shiftright("rank", BITS * levels)
    rows = nodes.select("key", "rank", "n", "digest", block.alias("block"), F.lit(levels).alias("levels"), "item")
    return rows.repartition("key", "block").sortWithinPartitions("key", "block", "rank")


def append_leaves(nodes: DataFrame, levels: int, item: T.DataType) -> tuple[DataFrame, DataFrame]:
    """One row for each run of 8 leaves with the witness they share inside their block, and the blocks' roots."""
    schema = T.StructType([
        T.StructField("key", T.StringType()), T.StructField("block", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("items", T.ArrayType(item)), T.StructField("path", PATH), T.StructField("block_root", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        for (key, block, n), frontier in _blocks(_remember(batches, seen := [])):
            kind = kind or seen[0]
            done = frontier.finish()
            yield pa.RecordBatch.from_arrays(
                [pa.array([key] * len(done)), pa.array([block] * len(done), pa.int64()), pa.array([n] * len(done), pa.int64()),
                 pa.array([[i for _, i in items] for items, _, _ in done], pa.list_(kind)),
                 pa.array([_flat(path) for _, _, path in done], A_PATH),
                 pa.array([frontier.root if i == 0 else None for i in range(len(done))], pa.binary())],
                [f.name for f in schema])

    runs = stage(_in_blocks(nodes, levels).mapInArrow(run, schema), "runs")
    roots = runs.where("block_root is not null").select("key", F.col("block").alias("rank"), "n", F.col("block_root").alias("digest"))
    return runs.drop("block_root"), roots


def _remember(batches: Iterator[pa.RecordBatch], seen: list) -> Iterator[pa.RecordBatch]:
    """Pass the batches on and note the type of their last column."""
    for batch in batches:
        if not seen:
            seen.append(batch.schema.types[-1])
        yield batch


def append_roots(nodes: DataFrame, levels: int) -> tuple[DataFrame, DataFrame]:
    """key, block, rank and witness of every node inside its block, and the blocks' roots as nodes of the next round."""
    schema = T.StructType([
        T.StructField("key", T.StringType()), T.StructField("block", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("rank", T.LongType()), T.StructField("path", PATH), T.StructField("block_root", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (key, block, n), frontier in _blocks(batches):
            ranks, paths = [], []
            for items, digests, path in frontier.finish():
                above = _flat(path)
                for i, (rank, _) in enumerate(items):
                    ranks.append(rank)
                    paths.append([b"".join(digests[:i]), b"".join(digests[i + 1:]), *above] if n > 1 else [])
            yield pa.RecordBatch.from_arrays(
                [pa.array([key] * len(ranks)), pa.array([block] * len(ranks), pa.int64()), pa.array([n] * len(ranks), pa.int64()),
                 pa.array(ranks, pa.int64()), pa.array(paths, A_PATH),
                 pa.array([frontier.root if i == 0 else None for i in range(len(ranks))], pa.binary())], [f.name for f in schema])

    found = stage(_in_blocks(nodes.withColumn("item", F.lit(0)), levels).mapInArrow(run, schema), "nodes")
    roots = found.where("block_root is not null").select("key", F.col("block").alias("rank"), "n", F.col("block_root").alias("digest"))
    return found.drop("block_root"), roots


def small(df: DataFrame, name: str) -> DataFrame:
    """Written once and broadcast up to a counted number of rows; a path has some 2 KB at most."""
    df = stage(df, name)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS // 10 else df


def climb(roots: DataFrame, levels: int) -> tuple[DataFrame, DataFrame]:
    """For block roots (key, rank, n leaves below in blocks of 8^levels): key, rank, path to the key's root; and key, root."""
    above = F.ceil(F.col("n") / F.lit(RUN ** levels)).cast("bigint")
    nodes = stage(roots.select("key", "rank", above.alias("n"), "digest"), "roots")
    if (nodes.agg(F.max("n")).first()[0] or 0) <= 1:
        return nodes.select("key", "rank", F.array().cast(PATH).alias("path")), nodes.select("key", F.col("digest").alias("root"))
    found, higher = append_roots(nodes, levels)
    paths, tops = climb(higher, levels)
    paths = small(paths.select(F.col("key").alias("of"), F.col("rank").alias("block_rank"), F.col("path").alias("rest")), "paths")
    joined = found.join(paths, (found["key"] == paths["of"]) & (found["block"] == paths["block_rank"]))
    return joined.select("key", "rank", F.concat("path", "rest").alias("path")), tops


def manifest(docs: DataFrame, group: str = "lang", fields: tuple[str, ...] = FIELDS, doc_id: str = "doc_id",
             changed: dict[str, Column] | None = None, levels: int = BLOCK_LEVELS) -> DataFrame:
    """One row for each run of up to 8 leaves: items (doc_id, leaf, shown), n leaves of the group, path, subroot, root.

    `path` holds the left and right siblings of every level above the run, up to the root of all. `shown` is the leaf of the
    document as `changed` (column name -> expression) has it now, else the leaf. Every row is a leaf: repeated rows too, which
    stand side by side; rows of one id are ordered by leaf. A null id comes first, as does the null group. No rows give none.
    """
    rows = leaves(docs, group, fields, doc_id, changed)
    item = F.struct("doc_id", "leaf", "shown")
    nodes = ranked(rows, ["doc_id", "leaf"]).select("key", "rank", "n", F.col("leaf").alias("digest"), item.alias("item"))
    runs, roots = append_leaves(nodes, levels, nodes.schema["item"].dataType)
    paths, tops = climb(roots, levels)
    tops = stage(tops.select(F.lit("").alias("key"), F.col("key").alias("group_key"), F.col("root").alias("digest")), "tops")
    groups = ranked(tops, ["group_key"]).withColumn("group", F.struct("group_key", F.col("digest").alias("subroot")))
    groups = stage(groups, "groups")
    last, last_roots = append_roots(groups, levels)
    last_paths, root = climb(last_roots, levels)
    last_paths = small(last_paths.select(F.col("rank").alias("top_block"), F.col("path").alias("top_path")), "paths")
    upper = last.join(last_paths, last["block"] == last_paths["top_block"]).select(
        F.col("rank").alias("top_rank"), F.concat("path", "top_path").alias("top"))
    root = F.broadcast(root.select(F.col("key").alias("root_key"), "root"))  # one row
    upper = groups.join(upper, groups["rank"] == upper["top_rank"]).join(root, groups["key"] == root["root_key"])
    upper = small(upper.select(F.col("group.group_key").alias("of"), "group.subroot", "top", "root"), "upper")
    paths = small(paths.select(F.col("key").alias("path_key"), F.col("rank").alias("path_block"), F.col("path").alias("middle")), "paths")
    joined = runs.join(paths, (runs["key"] == paths["path_key"]) & (runs["block"] == paths["path_block"])).join(upper, runs["key"] == upper["of"])
    return joined.select("items", "n", F.concat("path", "middle", "top").alias("path"), "subroot", "root")


def fold(node: bytes, path: list[bytes]) -> bytes:
    """The root that a node and its siblings lead to."""
    for left, right in zip(path[::2], path[1::2]):
        node = node_hash(left + node + right)
    return node


def proofs(found: DataFrame, digest: bool = False) -> DataFrame:
    """One row per document of a manifest: doc_id, leaf, subroot, root, its siblings level by level, folded_root, verified.

    `folded_root` is computed from the document's shown leaf and its siblings. With `digest` the siblings are their digest,
    proof_sha256.
    """
    item = found.schema["items"].dataType.elementType
    sides = T.StructField("proof_sha256", T.StringType()) if digest else T.StructField("siblings", T.ArrayType(T.StringType()))
    text = [T.StructField(name, T.StringType()) for name in ("leaf", "subroot", "root")]
    schema = T.StructType([item["doc_id"], *text, sides, T.StructField("folded_root", T.StringType()), T.StructField("verified", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column(0).flatten().field(0), []
            for items, n, path, subroot, root in zip(*[c.to_pylist() for c in batch.columns]):
                nodes = [i["leaf"] for i in items]
                above = hexlify(b"".join(path))
                roots: dict[bytes, bytes] = {}  # the shared path is folded once for each node it starts from
                for k, i in enumerate(items):
                    left, right = (b"".join(nodes[:k]), b"".join(nodes[k + 1:])) if n > 1 else (b"", b"")
                    start = node_hash(left + i["shown"] + right) if n > 1 else i["shown"]
                    if start not in roots:
                        roots[start] = fold(start, path)
                    beside = hexlify(left + right) + above
                    told = hashlib.sha256(beside).hexdigest() if digest else [beside[j:j + 64].decode() for j in range(0, len(beside), 64)]
                    rows.append((i["leaf"].hex(), subroot.hex(), root.hex(), told, roots[start].hex(), roots[start] == root))
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = [pa.string()] * 3 + [pa.string() if digest else pa.list_(pa.string()), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([ids, *[pa.array(c, k) for c, k in zip(columns, kinds)]], [f.name for f in schema])

    return found.mapInArrow(run, schema)


def audit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", levels: int = BLOCK_LEVELS) -> DataFrame:
    """Prove every document, and show that a change is noticed: where 3 divides the crc32 of the id's decimal digits, the text
    shown has its A-Z lower-cased. doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A text without A-Z, or null, is not changed by that and stays verified; so does a row without an id.
    """
    hit = F.crc32(F.col(doc_id).cast("string").cast("binary")) % TAMPERED == 0
    shown = F.when(hit, lower_ascii(F.col(text))).otherwise(F.col(text))
    return proofs(manifest(docs, changed={text: shown}, doc_id=doc_id, levels=levels), digest=True)
