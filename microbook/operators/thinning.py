"""Greedy thinning: keep the first event, then always the next one at least an interval after the last kept.

Which events stay depends on the whole path, but the path through a block of time depends only on the event it enters by, and it
enters by one of the few events within an interval of the block's start. So every block gives a jump table from entry to last
kept event, the tables of all blocks are composed by doubling, and the kept events inside a block follow from its entry.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from microbook.plans.ordered import Order, floor_to, running
from microbook.session import cut_lineage

WIDTH = 256  # intervals in a block


def reachable(starts: DataFrame, steps: DataFrame, keys: list[str], node: str = "node") -> DataFrame:
    """All nodes that the steps (keys, node, to; one a node) lead to from the starts (keys, node), by doubling the steps.

    The number of rounds is the logarithm of the longest way.
    """
    reached, n = cut_lineage(starts.select(*keys, node).distinct()), -1
    while (now := reached.count()) != n:
        n = now
        on = reached.join(steps, [*keys, node]).select(*keys, F.col("to").alias(node))
        reached = cut_lineage(reached.union(on).distinct())
        further = steps.select(*keys, F.col(node).alias("to"), F.col("to").alias("then"))
        steps = cut_lineage(steps.join(further, [*keys, "to"]).select(*keys, node, F.col("then").alias("to")))
    return reached


def _in_blocks(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    """The rows of each block of a sorted partition: the key columns' first row, and the other columns whole."""
    now, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        heads = list(zip(*[batch.column(i).to_pylist() for i in range(keys)]))
        edges = [0, *[i for i in range(1, len(heads)) if heads[i] != heads[i - 1]], len(heads)]
        for a, b in zip(edges, edges[1:]):
            part = [batch.column(i).slice(a, b - a) for i in range(keys, batch.num_columns)]
            if held and heads[a] != now:
                yield list(now), [pa.concat_arrays(c) for c in zip(*held)]
                held = []
            now = heads[a]
            held.append(part)
    if held:
        yield list(now), [pa.concat_arrays(c) for c in zip(*held)]


def _last_kept(ts: np.ndarray, interval: int) -> np.ndarray:
    """Index of the last event kept if the block is entered at each event."""
    step = np.append(np.searchsorted(ts, ts + interval), len(ts))
    last = np.where(step < len(ts), step, np.arange(len(step)))
    while (further := last[last])[:-1].tolist() != last[:-1].tolist():
        last = further
    return last[:-1]


def greedy(events: DataFrame, interval_us: int, order: Order, width: int = WIDTH) -> DataFrame:
    """Keys and position of the kept events. `events` has the order's keys and time, and `pos`, unique in a key and rising with it.

    Of events of one time only the first can be kept. A block of `width` intervals of one key is one task's unit.
    """
    k, ts = list(order.keys), order.ts
    block = interval_us * width
    distinct = events.groupBy(*k, ts).agg(F.min("pos").alias("pos")).withColumn("blk", floor_to(F.col(ts), block))
    distinct = cut_lineage(distinct.repartition(*k, "blk").sortWithinPartitions(*k, "blk", ts).select(*k, "blk", ts, "pos"))
    types = [distinct.schema[c] for c in k]
    edge = T.StructType([*types, *[T.StructField(c, T.LongType()) for c in ("blk", ts, "node", "exit")]])

    def jumps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for head, columns in _in_blocks(batches, len(k) + 1):
            at, pos = (c.to_numpy() for c in columns)
            # those near the block's start, and the first after them
            n = min(int(np.searchsorted(at, head[-1] + interval_us)) + 1, len(at))
            last = _last_kept(at, interval_us)[:n]
            fixed = [pa.array([v] * n, type=t) for v, t in zip(head, kinds)]
            yield pa.RecordBatch.from_arrays([*fixed, pa.array(at[:n]), pa.array(pos[:n]), pa.array(at[last])], [f.name for f in edge])

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for head, columns in _in_blocks(batches, len(k) + 1):
            at, pos, entry = (c.to_numpy(zero_copy_only=False) for c in columns)
            step, kept = np.searchsorted(at, at + interval_us).tolist(), []
            i = int(entry.argmax()) if entry.any() else len(at)
            while i < len(at):
                kept.append(i)
                i = step[i]
            fixed = [pa.array([v] * len(kept), type=t) for v, t in zip(head[:-1], kinds)]
            yield pa.RecordBatch.from_arrays([*fixed, pa.array(pos[kept])], [*k, "pos"])

    kinds = [{T.LongType: pa.int64(), T.IntegerType: pa.int32()}.get(type(f.dataType), pa.string()) for f in types] + [pa.int64()]
    table = cut_lineage(distinct.mapInArrow(jumps, edge))
    # where a block is left, the next entry is the first event an interval later, and the tables hold it
    exits = table.select(*k, (F.col("exit") + interval_us).alias(ts)).distinct().withColumns({"entry": F.lit(None).cast("bigint"), "side": F.lit(0).cast("bigint")})
    entries = table.select(*k, ts, F.col("node").alias("entry"), F.lit(1).cast("bigint").alias("side"))
    both = running(exits.union(entries), {"to": ("first", F.col("entry"))}, Order(order.keys, ts, ("side",), order.block_rows, order.cell))
    after = both.where("side = 0 and to is not null").select(*k, (F.col(ts) - interval_us).alias("exit"), "to")
    steps = cut_lineage(table.join(after, [*k, "exit"]).select(*k, "node", "to"))
    starts = table.groupBy(*k).agg(F.min("node").alias("node"))
    reached = reachable(starts, steps, k).withColumnRenamed("node", "pos").withColumn("entry", F.lit(True))
    inside = distinct.join(reached, [*k, "pos"], "left").select(*k, "blk", ts, "pos", F.coalesce("entry", F.lit(False)).alias("entry"))
    inside = inside.repartition(*k, "blk").sortWithinPartitions(*k, "blk", ts)
    return inside.mapInArrow(marked, T.StructType([*types, T.StructField("pos", T.LongType())]))
