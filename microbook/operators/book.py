"""Order-book reconstruction as joins over level intervals.

An event stream is numbered once per symbol (`pos`). Level changes become intervals of positions in
which a level keeps its size; the book at a tick is the set of intervals that contain its position.
Positions are cut into blocks of equal size, and every block starts from the levels still open
before it, so ticks meet only the intervals of their own block: the join is an equi join on
(symbol, block) with a range residual, balanced whatever the symbol's share of the data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from microbook.functions.expr import div, to_double
from microbook.functions.names import ladder
from microbook.operators import thinning, trimming
from microbook.plans.ordered import DEFAULT, Order, Spec, counted, floor_to, join_small, layout, over_rows, running
from microbook.session import cut_lineage

TRADE_RANK = 2**62
BLOCK = 16_384

# Order of raw events: exchange time, trades after depth updates, then input sequence.
EVENTS = Order(keys=("symbol",), ts="exchange_ts", ties=("event_seq",))


def with_event_seq(raw: DataFrame, seq: str = "seq") -> DataFrame:
    """Add the tie breaker that puts trades after depth updates of the same time."""
    rank = F.when(F.col("type") == "trade", F.lit(TRADE_RANK)).otherwise(F.lit(0)).cast("bigint")
    return raw.withColumn("event_seq", F.col(seq) + rank)


def with_symbol(raw: DataFrame, default: str = "BTCUSDT") -> DataFrame:
    """Upper-case symbols, with a default for records that carry none."""
    return raw.withColumn("symbol", F.upper(F.coalesce("symbol", F.lit(default))))


# --- sequence rules ---------------------------------------------------------------------------

def connection_gaps(df: DataFrame, order: Order = DEFAULT) -> DataFrame:
    """`sequence_gap` where prev_update_id is not the id applied before, and the id expected."""
    def build(d, w):
        last = F.lag("last_update_id").over(w)
        gap = last.isNotNull() & (F.col("prev_update_id") != last)
        return d.withColumns({"sequence_gap": gap, "expected_prev_id": F.when(gap, last)})

    return over_rows(df, build, order, back=1)


def sequence_status(df: DataFrame, rule: str = "apply", order: Order = DEFAULT) -> DataFrame:
    """Status of each update: first, ok, old, gap, or overlap; `applied` says whether it enters the book.

    Rule ``apply`` takes a gapped update into the book, so the reference point is the highest id seen. Rule ``reject`` leaves it
    out if its first id leaves a hole after the last id *applied*.
    """
    if rule == "reject":
        return _rejecting_status(df, order)
    df = running(df, {"_seen": ("max", F.col("last_update_id"))}, order, exclusive=True)
    seen = F.col("_seen")
    status = F.when(seen.isNull(), "first").when(F.col("prev_update_id") == seen, "ok")
    status = status.when(F.col("last_update_id") <= seen, "old").otherwise("gap")
    return df.withColumn("status", status).withColumn("applied", F.col("status") != "old").drop("_seen")


ID_BLOCK = 64


def _rejecting_status(df: DataFrame, order: Order) -> DataFrame:
    """The path rule as joins. Updates whose ids follow each other without a hole form a run; within one all or none apply from the
    first id past the last applied one on. Which run goes on from the end of another is one join over blocks of ids, and the runs
    that apply are what is reached from the first by doubling those steps.
    """
    keys, first, last, prev = list(order.keys), F.col("first_update_id"), F.col("last_update_id"), F.col("prev_update_id")

    def mark(d, w):
        before = F.lag("last_update_id").over(w)
        return d.withColumn("_starts", ~(prev.eqNullSafe(before) & first.eqNullSafe(before + 1)) | before.isNull())

    marked = over_rows(df, mark, order, back=1)
    marked = cut_lineage(running(marked, {"_run": ("sum", F.col("_starts").cast("bigint"))}, order))
    runs = cut_lineage(marked.groupBy(*keys, "_run").agg(
        F.min(first).alias("a"), F.max(last).alias("b"), F.min(F.when(F.col("_starts"), prev)).alias("p")))
    ends = runs.select(*keys, F.col("_run").alias("i"), F.col("b").alias("end"))
    blocks = runs.withColumn("at", F.explode(F.sequence(F.floor(F.col("a") / ID_BLOCK), F.floor(F.col("b") / ID_BLOCK))))
    spans = ends.withColumn("at", F.floor((F.col("end") + 1) / ID_BLOCK)).join(blocks, [*keys, "at"]).where(
        (F.col("_run") > F.col("i")) & (F.col("a") <= F.col("end") + 1) & (F.col("end") < F.col("b")))
    follows = ends.join(runs.withColumn("end", F.col("p")), [*keys, "end"]).where(F.col("_run") > F.col("i"))
    steps = spans.select(*keys, "i", "_run").union(follows.select(*keys, "i", "_run"))
    steps = cut_lineage(steps.groupBy(*keys, "i").agg(F.min("_run").alias("to")))
    steps = steps.withColumnRenamed("i", "_run")
    reached = thinning.reachable(runs.where("_run = 1"), steps, keys, "_run")
    runs = runs.join(reached.withColumn("_goes", F.lit(True)), [*keys, "_run"], "left")
    ends = running(runs.select(*keys, "_run", "_goes", "b"), {"_applied": ("last", F.when(F.col("_goes"), F.col("b")))},
                   Order(order.keys, "_run", ()), exclusive=True)
    out = join_small(marked, ends.select(*keys, "_run", "_goes", "_applied"), [*keys, "_run"], "left")
    done = F.col("_applied")
    status = (
        F.when(done.isNull(), F.when(F.col("_starts"), "first").otherwise("ok")).when(prev == done, "ok")
        .when(F.col("_goes") & (last > done), F.when(F.col("_starts") | (prev < done), "overlap").otherwise("ok"))
        .when(first > done + 1, "gap").otherwise("old")
    )
    return out.withColumn("status", status).withColumn("applied", ~F.col("status").isin("old", "gap")).drop(
        "_starts", "_run", "_goes", "_applied")


def consecutive_gaps(df: DataFrame, gap: Column, threshold: int = 5, order: Order = DEFAULT, reset: Column | None = None) -> DataFrame:
    """Number of gaps since the last reset up to each row, and whether a resync is due.

    A row is a gap, a reset (any row that is no gap unless `reset` says which), or neutral: it leaves the number as it is.
    """
    plan = layout(df, order)
    gap = F.coalesce(gap, F.lit(False))
    df = running(df.withColumn("_reset", ~gap if reset is None else F.coalesce(reset, F.lit(False)) & ~gap), {"_gaps": ("count", F.when(gap, 1))}, order, plan=plan)
    if not plan.single:
        df = cut_lineage(df)
    df = running(df, {"_before": ("max", F.when(F.col("_reset"), F.col("_gaps")))}, order, plan=plan)
    df = df.withColumn("consecutive_gaps", (F.col("_gaps") - F.coalesce("_before", F.lit(0))).cast("bigint"))
    return df.withColumn("needs_resync", F.col("consecutive_gaps") >= threshold).drop("_reset", "_gaps", "_before")


def resync_status(df: DataFrame, threshold: int = 5, order: Order = DEFAULT, crossed: str | None = None) -> DataFrame:
    """Status of each update under resynchronisation: first, ok, bridge, old or gap, and snapshot for full snapshots.

    Needs `type`, first, last and prev_update_id. An update goes on from the last applied id (ok), spans the id of the last snapshot
    (bridge), ends before the last applied id (old), or leaves a gap. Gaps are applied until `threshold` of them have come since the
    last ok or bridge; from then on they are not, until an update goes on from the last *applied* id, a bridge, or a snapshot. Old
    updates leave the count alone, and so does one that leaves the book crossed, which the boolean column `crossed` tells.

    Adds status, applied, consecutive_gaps and needs_resync. Snapshots cut the rows into epochs. In an epoch the last applied id is
    the highest seen up to the first row that changes that, a threshold reached or an id that goes back; all epochs settle the rows
    up to there at once and only what follows it is done again, so the number of rounds is that of such rows in one epoch.
    """
    full, last = F.coalesce(F.col("type") == "snapshot", F.lit(False)), F.col("last_update_id")
    rows = running(df.withColumn("_full", full), {
        "_pos": ("count", F.lit(1)), "_epoch": ("count", F.when(F.col("_full"), 1)), "_snap": ("last", F.when(F.col("_full"), last)),
    }, order)
    rows = cut_lineage(rows.withColumn("_crossed", F.coalesce(F.col(crossed), F.lit(False)) if crossed else F.lit(False)))
    return _resynced(rows, df.columns, threshold, order)


def _resynced(rows: DataFrame, names: list[str], threshold: int, order: Order) -> DataFrame:
    """The columns `names` and the status of numbered rows (see `resync_status`), which are read several times.

    `rows` also have _pos, rising with the order in a key; _full and _crossed; _epoch and _snap, the number of full snapshots up to
    the row and the id of the last one.
    """
    k, added = [*order.keys, "_epoch"], ["status", "applied", "consecutive_gaps"]
    first, last, prev, pos = (F.col(c) for c in ("first_update_id", "last_update_id", "prev_update_id", "_pos"))
    by = Order(tuple(k), "_pos", (), order.block_rows)
    zero = F.lit(0).cast("bigint")
    done = [rows.where("_full").withColumns({"status": F.lit("snapshot"), "applied": F.lit(True), "consecutive_gaps": zero})]
    starts = rows.groupBy(*k).agg(F.min(F.when(F.col("_full"), pos)).alias("_from"), F.max("_snap").alias("_base"))
    starts = starts.select(*k, F.coalesce("_from", zero).alias("_from"), "_base", zero.alias("_count"))
    rest = rows.where("not _full")
    # every round has some of these rows
    plan = layout(rest, by)

    def stored(d: DataFrame) -> DataFrame:
        # block totals read their rows a second time; plain windows of one order share a shuffle and a sort
        return d if plan.single else cut_lineage(d)

    def yes(c: Column) -> Column:
        return F.coalesce(c, F.lit(False))

    bridge = yes((first <= F.col("_snap")) & (F.col("_snap") <= last))
    while True:
        starts = counted(starts)
        if not starts.count():
            break
        live = stored(rest.join(starts, k).where(pos > F.col("_from")))
        live = running(live, {"_max": ("max", last)}, by, exclusive=True, plan=plan)
        seen = F.greatest("_max", "_base")
        status = F.when(seen.isNull(), "first").when(yes(prev == seen), "ok").when(bridge, "bridge").when(yes(last <= seen), "old").otherwise("gap")
        live = live.withColumns({"_seen": seen, "status": status})
        fresh = F.col("status").isin("first", "ok", "bridge")
        live = running(live, {"_gaps": ("count", F.when(F.col("status") == "gap", 1))}, by, plan=plan)
        live = stored(live.withColumn("_reset", fresh & ~F.col("_crossed")))
        live = running(live, {"_at": ("max", F.when(F.col("_reset"), F.col("_gaps")))}, by, plan=plan)
        live = live.withColumn("consecutive_gaps", F.when(F.col("_at").isNull(), F.col("_count") + F.col("_gaps")).otherwise(F.col("_gaps") - F.col("_at")))
        stuck = (F.col("status") == "gap") & (F.col("consecutive_gaps") >= threshold)
        back = fresh & yes(last < F.col("_seen"))
        live = cut_lineage(live.withColumns({"_stuck": stuck, "_back": back}).drop("_max", "_at"))
        at = F.struct("_pos", "_stuck", "_seen", F.col("consecutive_gaps").alias("n"), F.col("_gaps").alias("g"), last.alias("id"), "_reset")
        stops = counted(live.where("_stuck or _back").groupBy(*k).agg(F.min_by(at, "_pos").alias("_stop")))
        live = live.join(stops, k, "left")
        clear = F.col("_stop").isNull() | (pos < F.col("_stop._pos")) | ((pos == F.col("_stop._pos")) & ~F.col("_stop._stuck"))
        done.append(live.where(clear).withColumn("applied", F.col("status") != "old"))
        held = live.where(F.col("_stop._stuck") & (pos >= F.col("_stop._pos"))).select(
            *[c for c in rest.columns], F.col("_stop._seen").alias("_held"), F.col("_stop._pos").alias("_stop_pos"), F.col("_stop.n").alias("_n"))
        free = yes(prev == F.col("_held")) | bridge
        held = cut_lineage(held)
        ends = counted(held.where(free & (pos > F.col("_stop_pos"))).groupBy(*k).agg(F.min_by(
            F.struct("_pos", last.alias("id"), "_crossed", F.when(yes(prev == F.col("_held")), "ok").otherwise("bridge").alias("status")), "_pos").alias("_end")))
        frozen = held.join(ends, k, "left").where(F.col("_end").isNull() | (pos <= F.col("_end._pos")))
        leaves = F.coalesce(pos == F.col("_end._pos"), F.lit(False))
        frozen = frozen.withColumn("status", F.when(leaves, F.col("_end.status")).when(yes(last <= F.col("_held")), "old").otherwise("gap")).withColumn("applied", leaves)
        frozen = running(frozen, {"_more": ("count", F.when(F.col("status") == "gap", 1))}, by, plan=plan)
        count = F.when(leaves & ~F.col("_crossed"), zero).otherwise(F.col("_n") - 1 + F.col("_more"))
        frozen = cut_lineage(frozen.withColumn("consecutive_gaps", count))
        done.append(frozen)
        onward = frozen.where("applied").select(*k, pos.alias("_from"), last.alias("_base"), F.col("consecutive_gaps").alias("_count"))
        turned = stops.where("not _stop._stuck").select(*k, F.col("_stop._pos").alias("_from"), F.col("_stop.id").alias("_base"), F.when(F.col("_stop._reset"), zero).otherwise(F.col("_stop.n")).alias("_count"))
        starts = onward.union(turned)
    out = reduce(DataFrame.unionByName, [d.select(*names, *added) for d in done])
    return out.withColumn("needs_resync", F.col("consecutive_gaps") >= threshold)


# --- levels -----------------------------------------------------------------------------------

def all_levels(raw: DataFrame, *carry: str) -> DataFrame:
    """One row per level of a message: side, i (its place there), price, size, and `reason` if it cannot be read.

    A level needs two texts (``shape``) that are numbers (``price``, ``size``).
    """
    def changes(side: str) -> Column:
        return F.transform(
            F.coalesce(F.col(side + "s"), F.array().cast("array<array<string>>")),
            lambda level, i: F.struct(F.lit(side).alias("side"), to_double(F.get(level, 0)).alias("price"), to_double(F.get(level, 1)).alias("size"),
                                      i.alias("i"), F.coalesce(F.size(level) >= 2, F.lit(False)).alias("whole")),
        )

    rows = raw.select(*carry, F.explode(F.concat(changes("bid"), changes("ask"))).alias("c")).select(*carry, "c.*")
    reason = F.when(~F.col("whole"), "shape").when(F.col("price").isNull(), "price").when(F.col("size").isNull(), "size")
    return rows.withColumn("reason", reason).drop("whole")


def explode_levels(raw: DataFrame, *carry: str) -> DataFrame:
    """One row per level change: side, price, size. Levels that cannot be read are not changes; `level_rejects` lists them.

    A bad size is not read as 0, which would delete the level. If a message repeats a price, the last entry counts.
    """
    rows = all_levels(raw, *carry).filter("reason is null")
    return rows.groupBy(*carry, "side", "price").agg(F.max_by("size", "i").alias("size"))


def level_rejects(raw: DataFrame, *carry: str) -> DataFrame:
    """The levels that `explode_levels` leaves out, with their message's `carry` columns, side, place and reason."""
    return all_levels(raw, *carry).filter("reason is not null").select(*carry, "side", "i", "reason")


def level_intervals(deltas: DataFrame, pos: str = "u", keys: tuple[str, ...] = ("symbol",), block_rows: int | None = None) -> DataFrame:
    """Upserts and deletes as intervals [valid_from, valid_to) of each open level."""
    order = Order((*keys, "side", "price"), pos, (), block_rows)
    out = over_rows(deltas, lambda d, w: d.withColumn("valid_to", F.lead(pos).over(w)), order, ahead=1)
    out = out.filter(F.col("size") != 0)
    return out.select(*keys, "side", "price", "size", F.col(pos).alias("valid_from"), "valid_to")


def _block_intervals(deltas: DataFrame, ends: DataFrame, keys: list[str], block: int, depth: int) -> DataFrame:
    """Level intervals cut at block borders: those opened in a block, and those open before it that its ticks can reach."""
    at = [*keys, "side", "price"]
    d = deltas.withColumn("blk", F.floor(F.col("pos") / F.lit(block)).cast("bigint"))
    d = d.withColumn("_to", F.lead("pos").over(Window.partitionBy(*keys, "blk", "side", "price").orderBy("pos")))
    border = (F.col("blk") + 1) * block
    inside = d.filter(F.col("size") != 0).select(
        *at, "size", "blk", F.col("pos").alias("lo"), F.coalesce("_to", border).alias("hi")
    )
    closing = d.groupBy(*keys, "blk", "side", "price").agg(
        F.max_by("size", "pos").alias("size"), F.min("pos").alias("_first")
    )
    by_level = Window.partitionBy(*at).orderBy("blk")
    closing = closing.withColumns({
        "_next": F.lead("blk").over(by_level), "_touch": F.lead("_first").over(by_level)
    })
    open_ = join_small(closing.filter(F.col("size") != 0), ends, keys)
    upto = F.coalesce("_next", "_last")
    carried = open_.filter(upto > F.col("blk")).select(
        *at, "size", F.explode(F.sequence(F.col("blk") + 1, upto)).alias("blk"), "_next", "_touch"
    )
    carried = carried.select(
        *at, "size", "blk", (F.col("blk") * block).alias("lo"),
        F.when(F.col("blk") == F.col("_next"), F.col("_touch")).otherwise(border).alias("hi"),
    )
    return inside.unionByName(_in_reach(carried, keys, block, depth))


def book_at(
    deltas: DataFrame, ticks: DataFrame, depth: int = 10, keys: tuple[str, ...] = ("symbol",),
    block: int = BLOCK,
) -> DataFrame:
    """Top `depth` levels of both sides at each tick, as wide rows padded with nulls.

    `deltas`: keys, pos, side, price, size (0 deletes). `ticks`: keys, pos and any other columns,
    unique in (keys, pos); the book is the one after the change at `pos`.
    """
    k = list(keys)
    columns, at = ticks.columns, [*k, "blk", "pos"]
    more = set(columns) - set(at)
    ticks = ticks.withColumn("blk", F.floor(F.col("pos") / F.lit(block)).cast("bigint"))
    if more:  # they are read three times
        ticks = cut_lineage(ticks)
    ends = ticks.groupBy(*k).agg(F.max("blk").alias("_last"))
    levels = _block_intervals(deltas.select(*k, "pos", "side", "price", "size"), ends, k, block, depth)
    # few ticks go to the intervals, so those are not moved once more
    t, v = (counted(ticks.select(*at)) if more else ticks.select(*at)).alias("t"), levels.alias("v")
    same = [F.col(f"t.{c}") == F.col(f"v.{c}") for c in [*k, "blk"]]
    inside = (F.col("t.pos") >= F.col("v.lo")) & (F.col("t.pos") < F.col("v.hi"))
    held = t.join(v, [*same, inside], "inner" if more else "left").select("t.*", "v.side", "v.price", "v.size")
    on = {side: F.col("side") == side for side in ("bid", "ask")}
    if depth == 1:  # the best level is a maximum or minimum: no ranking, and a hash aggregate
        best = {"bid": (F.max, F.max_by), "ask": (F.min, F.min_by)}
        tops = [x for s, (edge, by) in best.items() for x in (
            edge(F.when(on[s], F.col("price"))).alias(f"{s}_px_01"), by("size", F.when(on[s], F.col("price"))).alias(f"{s}_sz_01"))]
        out, wide = held.groupBy(*at).agg(*tops), [f"{s}_{x}_01" for s in best for x in ("px", "sz")]
    else:
        ranks = Window.partitionBy(*at, "side").orderBy(_distance())
        held = held.withColumn("_level", F.row_number().over(ranks)).filter(F.col("_level") <= depth)
        level = F.struct(F.col("_level"), F.col("price").alias("px"), F.col("size").alias("sz"))
        out = held.groupBy(*at).agg(*[F.sort_array(F.collect_list(F.when(on[s], level))).alias(f"_{s}s") for s in on])
        wide = _wide_columns("_bids", "_asks", depth)
    # the other columns of a tick are joined to its book once, not carried along with every level
    return (ticks.join(out, at, "left") if more else out).selectExpr(*columns, *wide)


def _distance() -> Column:
    """Rises from the best price of a side to the worst."""
    return F.when(F.col("side") == "bid", -F.col("price")).otherwise(F.col("price"))


def _in_reach(levels: DataFrame, keys: list[str], block: int, depth: int) -> DataFrame:
    """Of the levels open through a whole block only the best `depth` a side: the others are behind those at every tick of it."""
    through = (F.col("lo") == F.col("blk") * block) & (F.col("hi") == (F.col("blk") + 1) * block)
    ranks = Window.partitionBy(*keys, "blk", "side", "_through").orderBy(_distance())
    ranked = levels.withColumn("_through", through).withColumn("_rank", F.row_number().over(ranks))
    return ranked.filter(~F.col("_through") | (F.col("_rank") <= depth)).drop("_through", "_rank")


def _wide_columns(bids: str, asks: str, depth: int) -> list[str]:
    """Ladder columns taken from two level arrays, null where a level is missing."""
    return [
        f"get({side}s, {i}).{what} as {name}_{what}_{i + 1:02d}"
        for name, side in (("bid", bids[:-1]), ("ask", asks[:-1])) for i in range(depth) for what in ("px", "sz")
    ]


def initialised(snapshots: DataFrame) -> DataFrame:
    """Snapshots with at least one level on both sides."""
    return snapshots.filter(F.col("bid_px_01").isNotNull() & F.col("ask_px_01").isNotNull())


def with_top(snapshots: DataFrame) -> DataFrame:
    """best_bid, best_ask and the crossed flag."""
    bid, ask = F.col("bid_px_01"), F.col("ask_px_01")
    return snapshots.withColumns({
        "best_bid": bid, "best_ask": ask,
        "book_crossed": F.coalesce(bid >= ask, F.lit(False)),
    })


def grid_ticks(events: DataFrame, interval_us: int, order: Order = DEFAULT, at: str | None = None) -> DataFrame:
    """First event of every interval of every key.

    `at` names a column that numbers the events in `order`, if there is one. Columns of fixed width are hash aggregates.
    """
    columns = [c for c in events.columns if c not in order.keys]
    numbered = events.withColumns({"_cell": floor_to(F.col(order.ts), interval_us), "_at": F.col(at) if at else order.packed()})
    first = [F.min_by(c, "_at").alias(c) for c in columns]
    return numbered.groupBy(*order.keys, "_cell").agg(*first).drop("_cell")


def open_counts(deltas: DataFrame, keys: tuple[str, ...], block: int, blocks: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """How many levels of each side are open: after every change that alters a number, and before each block of positions.

    Each change adds 1 to its side if it opens a level, -1 if it closes one; the numbers are running sums by position, in a block
    and over the blocks' totals. First table: keys, blk, pos, bids, asks, and `_bids`, `_asks`, the numbers before the block.
    Second: keys, blk, `_bids`, `_asks` for the blocks with changes and those in `blocks` (keys, blk).
    """
    k = list(keys)
    d = deltas.withColumn("blk", F.floor(F.col("pos") / F.lit(block)).cast("bigint"))
    level = [*k, "blk", "side", "price"]
    is_open = (F.col("size") != 0).cast("int")
    before = F.lag(is_open).over(Window.partitionBy(*level).orderBy("pos"))
    inside = d.select(*level, "pos", (is_open - before).alias("_step")).where("_step <> 0")  # null for the first of a block
    ends = d.groupBy(*level).agg(F.min("pos").alias("pos"), F.min_by(is_open, "pos").alias("_first"), F.max_by(is_open, "pos").alias("_last"))
    earlier = F.lag("_last").over(Window.partitionBy(*k, "side", "price").orderBy("blk"))
    entering = ends.select(*level, "pos", (F.col("_first") - F.coalesce(earlier, F.lit(0))).alias("_step")).where("_step <> 0")
    sides = {"bids": F.when(F.col("side") == "bid", F.col("_step")).otherwise(0), "asks": F.when(F.col("side") == "ask", F.col("_step")).otherwise(0)}
    steps = cut_lineage(inside.unionByName(entering).groupBy(*k, "blk", "pos").agg(*[F.sum(c).alias(n) for n, c in sides.items()]))
    totals = steps.groupBy(*k, "blk").agg(*[F.sum(n).alias(n) for n in sides])
    if blocks is not None:
        none = [F.lit(0).cast("bigint").alias(n) for n in sides]
        totals = totals.unionByName(blocks.select(*k, "blk", *none)).groupBy(*k, "blk").agg(*[F.sum(n).alias(n) for n in sides])
    past = Window.partitionBy(*k).orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    prefix = counted(totals.select(*k, "blk", *[F.coalesce(F.sum(n).over(past), F.lit(0)).alias(f"_{n}") for n in sides]))
    here = Window.partitionBy(*k, "blk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    out = steps.join(prefix, [*k, "blk"])
    return out.withColumns({n: F.sum(n).over(here) + F.col(f"_{n}") for n in sides}), prefix


def _two_sided(marks: DataFrame, deltas: DataFrame, keys: tuple[str, ...], block: int) -> DataFrame:
    """keys, pos: those of the marked positions (keys, pos) after which both sides are open, and the positions that complete a book."""
    k = list(keys)
    marks = cut_lineage(marks.withColumn("blk", F.floor(F.col("pos") / F.lit(block)).cast("bigint")))
    counts, prefix = open_counts(deltas, keys, block, marks.select(*k, "blk").distinct())
    both, before = (F.col("bids") > 0) & (F.col("asks") > 0), (F.col("_bids") > 0) & (F.col("_asks") > 0)
    in_block = Window.partitionBy(*k, "blk").orderBy("pos")
    counts = counts.select(*k, "blk", "pos", both.alias("_open"), F.coalesce(F.lag(both).over(in_block), before).alias("_was"))
    flips = counts.where("_open <> _was").select(*k, "blk", "pos", "_open")
    none = F.lit(None).cast("boolean")
    marks = marks.join(prefix, [*k, "blk"]).select(*k, "blk", "pos", before.alias("_before"), none.alias("_open"))
    # a flip at a marked position counts for it
    rows = marks.unionByName(flips.withColumn("_before", none)).groupBy(*k, "blk", "pos").agg(*[F.max(c).alias(c) for c in ("_before", "_open")])
    last = F.last("_open", ignorenulls=True).over(in_block)
    rows = rows.withColumn("_ready", F.when(F.col("_before").isNotNull(), F.coalesce(last, "_before")).otherwise(F.col("_open")))
    return rows.where("_ready").select(*k, "pos")


def two_sided_ticks(
    events: DataFrame, deltas: DataFrame, interval_us: int, order: Order = DEFAULT, keys: tuple[str, ...] = ("symbol",),
    block: int = BLOCK,
) -> DataFrame:
    """First event of every interval at which both sides have an open level; intervals without one give no row.

    `events` and `deltas` have `keys`, the order's time and `pos`, deltas also side, price and size; the book is the one after
    the event. Such an event is the first of its interval, or one whose change completes the book.
    """
    k, cell = list(keys), floor_to(F.col(order.ts), interval_us)
    firsts = events.select(*k, cell.alias("_cell"), "pos").groupBy(*k, "_cell").agg(F.min("pos").alias("pos"))
    at = join_small(events, _two_sided(firsts.select(*k, "pos"), deltas, keys, block), [*k, "pos"])
    first = [F.min_by(c, "pos").alias(c) for c in events.columns if c not in order.keys]
    return at.withColumn("_cell", cell).groupBy(*order.keys, "_cell").agg(*first).select(*events.columns)


def greedy_ticks(
    events: DataFrame, deltas: DataFrame, interval_us: int, order: Order = DEFAULT, keys: tuple[str, ...] = ("symbol",),
    block: int = BLOCK, width: int = thinning.WIDTH,
) -> DataFrame:
    """The first event with a two-sided book, then always the next such event at least an interval after the last one taken."""
    k = list(keys)
    ready = events.join(_two_sided(events.select(*k, "pos"), deltas, keys, block), [*k, "pos"], "left_semi")
    kept = thinning.greedy(ready.select(*order.keys, order.ts, "pos"), interval_us, order, width)
    return join_small(events, kept, [*order.keys, "pos"]).select(*events.columns)


def trade_state(events: DataFrame, order: Order = DEFAULT, plan=None, more: Spec | None = None) -> DataFrame:
    """Last trade and cumulative taker volumes as of each event.

    Needs trade_px, trade_qty and buyer_is_maker, null on other events. A maker buyer means the
    taker sold. Volumes never reset. `more` are running aggregates to take in the same pass.
    """
    qty, maker = F.col("trade_qty"), F.col("buyer_is_maker")
    out = running(events, {
        "last_trade_px": ("last", F.col("trade_px")),
        "last_trade_qty": ("last", qty),
        "taker_buy_vol": ("sum", F.when(~maker, qty)),
        "taker_sell_vol": ("sum", F.when(maker, qty)),
        **(more or {}),
    }, order, plan=plan)
    return out.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("taker_buy_vol", "taker_sell_vol")})


def reconstruct(
    raw: DataFrame, interval_us: int = 100_000, depth: int = 10, block: int = BLOCK,
    block_rows: int | None = None, emit: str = "grid", threshold: int | None = 5, max_depth: int | None = trimming.MAX_DEPTH,
) -> DataFrame:
    """Raw depth, trade and snapshot records to clean rows: the first event of each symbol and grid interval with a two-sided book.

    With `emit` as ``greedy`` intervals start at the last row instead of the grid. A record of type ``snapshot`` closes every level
    of its symbol and opens the ones it lists. Old updates, and gaps from the `threshold`-th on, stay out of the book (see
    `resync_status`); with None every update is applied. A side forgets the levels behind its best `max_depth` after each event
    (see `trimming`); with None it keeps all.
    """
    if emit not in ("grid", "greedy"):
        raise ValueError(f"unknown way to emit {emit!r}")
    order = Order(EVENTS.keys, EVENTS.ts, EVENTS.ties, block_rows)
    trade, full, last = F.col("trade"), F.col("type") == "snapshot", F.col("last_update_id")
    events = with_event_seq(with_symbol(raw)).filter(F.col("type").isin("depth", "trade", "snapshot"))
    events = events.withColumns({
        "trade_px": to_double(trade["price"]), "trade_qty": to_double(trade["quantity"]),
        "buyer_is_maker": trade["buyer_is_maker"],
    })
    # the records are read once: blocks are measured, totalled and numbered from here
    events = cut_lineage(events.drop("trade", "liquidation", "kline", "meta"))
    events = trade_state(events, order, more={
        "pos": ("count", F.lit(1)), "epoch": ("count", F.when(full, 1)), "update_id": ("last", last),
        "_snap": ("last", F.when(full, last)),
    })
    # numbered once, read by the ticks, the level changes and the carried levels
    events = cut_lineage(events)
    updates = events.filter(F.col("type") != "trade")
    if threshold is not None:
        levels = ["symbol", "epoch", "pos", "bids", "asks"]
        rows = updates.select(*levels, "first_update_id", "last_update_id", "prev_update_id", "_snap", F.col("pos").alias("_pos"),
                              F.col("epoch").alias("_epoch"), full.alias("_full"), F.lit(False).alias("_crossed"))
        updates = _resynced(rows, levels, threshold, Order(("symbol",), "pos", (), block_rows)).filter("applied")
    deltas = cut_lineage(explode_levels(updates, "symbol", "epoch", "pos"))
    if max_depth is not None:
        deltas = cut_lineage(trimming.trim_levels(deltas, max_depth, ("symbol", "epoch"), block))
    ticks = (two_sided_ticks if emit == "grid" else greedy_ticks)(
        events.select("symbol", "exchange_ts", "event_seq", "local_ts", "update_id", "epoch", "pos",
                      "last_trade_px", "last_trade_qty", "taker_buy_vol", "taker_sell_vol"),
        deltas, interval_us, order, ("symbol", "epoch"), block,
    )
    wide = book_at(deltas, ticks, depth, ("symbol", "epoch"), block)
    levels = [c for c in wide.columns if c[:7] in ("bid_px_", "bid_sz_", "ask_px_", "ask_sz_")]
    return wide.select(
        "symbol", F.col("exchange_ts").alias("ts"), F.col("pos").alias("seq"), "local_ts",
        F.col("update_id").alias("last_update_id"), *levels,
        "last_trade_px", "last_trade_qty", "taker_buy_vol", "taker_sell_vol",
    )


# --- nested snapshots -------------------------------------------------------------------------

def to_nested(wide: DataFrame, depth: int = 10) -> DataFrame:
    """Fold ladder columns into `bids` and `asks`, arrays of (px, sz) without null padding."""
    for side in ("bid", "ask"):
        pairs = zip(ladder(side, "px", depth), ladder(side, "sz", depth))
        levels = F.array(*[F.struct(F.col(p).alias("px"), F.col(s).alias("sz")) for p, s in pairs])
        wide = wide.withColumn(side + "s", F.filter(levels, lambda x: x["px"].isNotNull()))
    return wide.drop(*[c for s in ("bid", "ask") for w in ("px", "sz") for c in ladder(s, w, depth)])


def to_wide(nested: DataFrame, depth: int = 10) -> DataFrame:
    """The flat clean row of a nested snapshot, null-padded to `depth` levels."""
    return nested.selectExpr("*", *_wide_columns("bids", "asks", depth)).drop("bids", "asks")


def side_volume(side: str, depth: int) -> Column:
    """Size on the first `depth` levels of a nested side."""
    return F.aggregate(F.slice(F.col(side), 1, depth), F.lit(0.0), lambda total, level: total + level["sz"])


def book_properties(nested: DataFrame, depth: int = 1) -> DataFrame:
    """Mid, spread, volumes to `depth` and imbalance (0 for an empty book) of nested snapshots."""
    bid = F.try_element_at("bids", F.lit(1))["px"]
    ask = F.try_element_at("asks", F.lit(1))["px"]
    b, a = side_volume("bids", depth), side_volume("asks", depth)
    return nested.withColumns({
        "mid": (bid + ask) / 2, "spread": ask - bid,
        "bid_volume": b, "ask_volume": a,
        "imbalance": F.coalesce(div(b - a, b + a), F.lit(0.0)),
    })


def health(events: DataFrame) -> DataFrame:
    """Counters per symbol; needs type, local_ts, exchange_ts, sequence_gap, book_crossed, snapshot."""
    late = F.col("local_ts") - F.col("exchange_ts")
    return events.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("events_processed"),
        F.count_if(F.col("type") == "depth").alias("depth_updates"),
        F.count_if(F.col("type") == "trade").alias("trades_processed"),
        F.count_if(F.col("sequence_gap")).alias("sequence_gaps"),
        F.count_if(F.col("book_crossed")).alias("crossed_books"),
        F.count_if(F.col("snapshot")).alias("snapshots_emitted"),
        F.max(F.greatest(late, F.lit(0).cast("bigint"))).alias("max_latency_us"),
        F.max("exchange_ts").alias("last_event_ts"),
    )
