"""Row-ordered operators that do not need one task per symbol.

``Window.partitionBy("symbol")`` puts all rows of a symbol in one task; one symbol may hold a third
of the data. Here the rows of a key are cut into consecutive blocks of about ``block_rows`` rows and
windows run per block:

* rolling frames, ``lag`` and ``lead`` get the rows they need from the neighbouring block (a halo);
* running aggregates and row numbers add a prefix taken from the small table of block totals.

Blocks are cut from row counts per time cell: one pass over the key and order columns, combined
map-side. Cells that are too full are cut again by the first order column that varies in them, each
into as many equal parts of its own range as its rows need, so a burst or a mass of equal timestamps
is split as well, the number of cells follows that of rows, and few passes do. If no key has more than
``block_rows`` rows, the plain window is used and nothing is added to the plan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from microbook.session import BROADCAST_ROWS, cut_lineage

NO_TIE = -(2**63)
BLOCK_ROWS = (131_072, 1_048_576)
WHOLE = ("bigint", "int", "smallint", "tinyint")
WIDEST = 2**62


@dataclass(frozen=True)
class Order:
    """How rows are keyed and ordered: `keys`, then (`ts`, *`ties`); `ts` is a bigint.

    `ties` makes the order total; its first column must be a bigint. Ties that are whole numbers may cut equal timestamps, each
    where the ones before it are equal.
    Without `block_rows`, blocks hold a fair share of the rows per core, within `BLOCK_ROWS`.
    """

    keys: tuple[str, ...] = ("symbol",)
    ts: str = "ts"
    ties: tuple[str, ...] = ("seq",)
    block_rows: int | None = None
    cell: int = 3_600_000_000

    @property
    def columns(self) -> list[str]:
        return [self.ts, *self.ties]

    def by(self, *keys: str) -> "Order":
        return replace(self, keys=tuple(keys))

    def blocks(self, rows: int, cell: int | None = None) -> "Order":
        return replace(self, block_rows=rows, cell=cell or self.cell)

    @property
    def cells(self) -> list[str]:
        """The columns that name a cell: lower bounds of its time and of its tie breakers."""
        return ["_ct", *[f"_c{i}" for i in range(len(self.ties))]]

    def stamp(self) -> Column:
        """The order columns as one comparable value."""
        return F.struct(*self.columns)

    def packed(self) -> Column:
        """The order columns as one number, so that `min_by` and `max_by` keep it in a hash aggregate's buffer.

        A struct there forces a sort of all rows before the map-side combine. Holds for one tie breaker and times within
        5e18; with more tie breakers it is the struct. A null tie breaker comes first, a null time is passed over.
        """
        if not self.ties:
            return F.col(self.ts)
        if len(self.ties) > 1:
            return self.stamp()
        tie = F.coalesce(F.col(self.ties[0]).cast("decimal(20,0)") + F.lit(Decimal(1 << 63)).cast("decimal(20,0)"), F.lit(0))
        return (F.col(self.ts).cast("decimal(19,0)") * F.lit(Decimal(1 << 64)).cast("decimal(20,0)") + tie).cast("decimal(38,0)")


DEFAULT = Order()


def floor_to(value: Column, width: int) -> Column:
    """Largest multiple of `width` not above `value` (also below zero)."""
    return value - F.pmod(value, F.lit(width).cast("bigint"))


class Layout:
    """Block boundaries of one ordered table (see `layout`)."""

    def __init__(self, order: Order, cells: DataFrame | None, n_cells: int, hot: list):
        self.order = order
        self.cells = cells
        self.n_cells = n_cells
        self.hot = hot

    @property
    def single(self) -> bool:
        """True when every key fits one block, so plain windows are safe."""
        return self.cells is None

    def window(self, blocked: bool = True, reverse: bool = False) -> WindowSpec:
        keys = list(self.order.keys) + ([] if self.single or not blocked else ["_blk"])
        return Window.partitionBy(*keys).orderBy(*[F.col(c).desc() if reverse else F.col(c) for c in self.order.columns])

    def assign(self, df: DataFrame, back: int = 0, ahead: int = 0) -> DataFrame:
        """Add `_blk`, `_lo`, `_total` and `_halo`; rows near an edge are copied to the neighbour."""
        rows, at = self.order.block_rows, self.order.cells
        keys = list(self.order.keys)
        # a frame that fits a block reaches the next one at most
        near = max(back, ahead) < rows - rows // 16
        cells = self.cells
        if near:
            reach = [((F.col("_end") > F.col("_hi") - back) & (F.col("_hi") < F.col("_total"))).alias("_next"),
                     ((F.col("_off") < F.col("_lo") + ahead) & (F.col("_blk") > 0)).alias("_prev")]
        else:
            # blocks start less than a cell after their multiple of `rows`; the last rows before a block and the first after it
            # are those whose cells reach into its frames
            cells = cells.withColumn("_last", F.max("_blk").over(Window.partitionBy(*keys)))
            reach = [F.least("_last", F.floor((F.col("_end") + back - 1) / F.lit(rows))).cast("bigint").alias("_to") if back else F.col("_blk").alias("_to"),
                     F.greatest(F.lit(0), F.floor((F.col("_off") - ahead - rows // 16 - 1) / F.lit(rows))).cast("bigint").alias("_from") if ahead
                     else F.col("_blk").alias("_from")]
        cells = cells.select(*keys, *at, "_blk", "_lo", "_total", *reach)
        if self.n_cells <= BROADCAST_ROWS:
            cells = F.broadcast(cells)
        out = _locate(df, self.order, self.hot).join(cells, [*keys, *at], "left")
        out = out.withColumn("_blk", F.coalesce("_blk", F.lit(0).cast("bigint")))
        if not near:
            blocks = F.sequence(F.coalesce("_from", "_blk"), F.coalesce("_to", "_blk"))
            out = out.withColumn("_copy", F.explode(F.transform(blocks, lambda b: F.struct(b.alias("b"), (b != F.col("_blk")).alias("h")))))
            out = out.drop(*at, "_from", "_to")
        elif not (back or ahead):
            return out.drop(*at, "_next", "_prev").withColumn("_halo", F.lit(False))
        else:
            home = F.array(F.struct(F.col("_blk").alias("b"), F.lit(False).alias("h")))
            copies = [home]
            none = F.slice(home, 1, 0)
            if back:
                after = F.array(F.struct((F.col("_blk") + 1).alias("b"), F.lit(True).alias("h")))
                copies.append(F.when(F.col("_next"), after).otherwise(none))
            if ahead:
                before = F.array(F.struct((F.col("_blk") - 1).alias("b"), F.lit(True).alias("h")))
                copies.append(F.when(F.col("_prev"), before).otherwise(none))
            out = out.withColumn("_copy", F.explode(F.concat(*copies))).drop(*at, "_next", "_prev")
        return out.withColumn("_blk", F.col("_copy.b")).withColumn("_halo", F.col("_copy.h")).drop("_copy")


def _locate(df: DataFrame, order: Order, hot: list) -> DataFrame:
    """Add the lower bounds (`Order.cells`) of the cell of each row, after the cuts listed in `hot`."""
    at = order.cells
    df = df.withColumns({"_ct": floor_to(F.col(order.ts), order.cell), **{c: F.lit(NO_TIE).cast("bigint") for c in at[1:]}})
    for cells, n_cells in hot:
        if n_cells <= BROADCAST_ROWS:
            cells = F.broadcast(cells)
        df = df.join(cells, [*order.keys, *at], "left")
        for i, (column, target) in enumerate(zip(order.columns, at)):
            if dict(df.dtypes)[column] in WHOLE:
                x = F.col(column).cast("bigint")
                finer = F.when(F.col("_width") == WIDEST, floor_to(x, WIDEST)).otherwise(x - F.pmod(x - F.col("_base"), F.col("_width")))
                # a null tie breaker comes first
                df = df.withColumn(target, F.when(F.col("_cut") == i, F.coalesce(finer, F.lit(NO_TIE).cast("bigint"))).otherwise(F.col(target)))
        df = df.drop("_cut", "_base", "_width")
    return df


def layout(df: DataFrame, order: Order = DEFAULT) -> Layout:
    """Measure `df` and cut it into blocks. Runs one small aggregate; more only for hot cells."""
    keys = list(order.keys)
    at = order.cells
    narrow = df.select(*keys, *order.columns)

    types = dict(narrow.dtypes)
    ranges = []
    for i, c in enumerate(order.columns):
        x = F.col(c).cast("bigint") if types[c] in WHOLE else F.xxhash64(c)  # of others only whether they vary
        ranges += [F.min(x).alias(f"_min{i}"), F.max(x).alias(f"_max{i}"), F.count(c).alias(f"_set{i}")]

    def count_cells(hot: list) -> DataFrame:
        located = _locate(narrow, order, hot)
        return cut_lineage(located.groupBy(*keys, *at).agg(F.count(F.lit(1)).alias("_n"), *ranges))

    found = count_cells([])
    sizes = found.groupBy(*keys).agg(F.sum("_n").alias("rows")).agg(F.max("rows"), F.sum("rows")).first()
    if order.block_rows is None:
        share = (sizes[1] or 0) // (2 * df.sparkSession.sparkContext.defaultParallelism)
        order = order.blocks(min(max(share, BLOCK_ROWS[0]), BLOCK_ROWS[1]))
    if (sizes[0] or 0) <= order.block_rows:
        return Layout(order, None, 0, [])

    limit = max(order.block_rows // 16, 1)
    cut, low, span = F.lit(None).cast("int"), F.lit(None).cast("bigint"), F.lit(None).cast("double")
    for i in reversed(range(len(order.columns))):
        lo, hi, there = F.col(f"_min{i}"), F.col(f"_max{i}"), F.col(f"_set{i}")
        varies = F.coalesce(lo < hi, F.lit(False)) | ((there > 0) & (there < F.col("_n")))
        cut, low = F.when(varies, i).otherwise(cut), F.when(varies, lo).otherwise(low)
        span = F.when(varies, hi.cast("double") - lo.cast("double") + 1).otherwise(span)
    pieces = F.ceil(2 * F.col("_n") / F.lit(limit))
    width = F.when(span >= float(WIDEST), F.lit(WIDEST)).otherwise(F.greatest(F.ceil(span / pieces), F.lit(1)).cast("bigint"))
    fixed = [i for i, c in enumerate(order.columns) if types[c] not in WHOLE]
    hot: list = []
    while True:
        full = found.filter((F.col("_n") > limit) & F.col("_ct").isNotNull())
        full = cut_lineage(full.select(*keys, *at, cut.alias("_cut"), low.alias("_base"), width.alias("_width")))
        n_full = full.count()
        if n_full == 0:
            break
        if not full.filter(F.col("_cut").isNull() | F.col("_cut").isin(fixed)).isEmpty():
            raise ValueError(f"over {limit} rows share one {order.ts} and {order.ties}: add a tie breaker")
        hot.append((full, n_full))
        found = count_cells(hot)

    # places are summed in each first cell, and over those
    coarse = F.coalesce(floor_to(F.col("_ct"), order.cell), F.lit(NO_TIE).cast("bigint"))
    found = found.select(*keys, *at, "_n", coarse.alias("_first"))
    sums = found.groupBy(*keys, "_first").agg(F.sum("_n").alias("_sum"))
    past = Window.partitionBy(*keys).orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, "_first", F.coalesce(F.sum("_sum").over(past), F.lit(0)).alias("_past"), F.sum("_sum").over(Window.partitionBy(*keys)).alias("_total"))
    inside = Window.partitionBy(*keys, "_first").orderBy(*at).rowsBetween(Window.unboundedPreceding, 0)
    block = Window.partitionBy(*keys, "_blk")
    cells = (
        join_small(found, sums, [*keys, "_first"])
        .withColumn("_end", F.sum("_n").over(inside) + F.col("_past"))
        .withColumn("_off", F.col("_end") - F.col("_n"))
        .withColumn("_blk", F.floor(F.col("_off") / F.lit(order.block_rows)).cast("bigint"))
        .withColumn("_lo", F.min("_off").over(block))
        .withColumn("_hi", F.max("_end").over(block))
        .drop("_first", "_past")
    )
    cells = cut_lineage(cells)
    return Layout(order, cells, cells.count(), hot)


MANY = 8


def _pack(df: DataFrame, used: list[str]) -> tuple[DataFrame, list[str]]:
    """Fold the columns a window does not use into one struct, which it copies as a block of bytes."""
    rest = [c for c in df.columns if c not in used]
    if len(rest) < MANY:
        return df, []
    kept = [f"`{c}`" for c in df.columns if c in used]
    return df.selectExpr(*kept, f"struct({', '.join(f'`{c}`' for c in rest)}) as _rest"), rest


def _unpack(df: DataFrame, rest: list[str], first: list[str]) -> DataFrame:
    """Undo `_pack`; `first` are the original columns, in order."""
    if not rest:
        return df
    added = [c for c in df.columns if c not in first and c != "_rest"]
    have = set(df.columns) | set(rest)
    old = [f"_rest.`{c}` as `{c}`" if c in rest else f"`{c}`" for c in first if c in have]
    return df.selectExpr(*old, *[f"`{c}`" for c in added])


def over_rows(
    df: DataFrame,
    build: Callable[[DataFrame, WindowSpec], DataFrame],
    order: Order = DEFAULT,
    back: int = 0,
    ahead: int = 0,
    plan: Layout | None = None,
    uses: list[str] | None = None,
) -> DataFrame:
    """Run ``build(df, window)``, whose frames reach `back` rows behind and `ahead` rows ahead.

    `uses` names the columns `build` reads; the others are then carried past the windows in one piece.
    """
    plan = plan or layout(df, order)
    first, rest = df.columns, []
    if uses is not None:
        df, rest = _pack(df, [*order.keys, *order.columns, *uses])
    if plan.single:
        return _unpack(build(df, plan.window()), rest, first)
    out = build(plan.assign(df, back, ahead), plan.window())
    out = out.filter(~F.col("_halo")).drop("_blk", "_lo", "_total", "_halo")
    return _unpack(out, rest, first)


def row_index(
    df: DataFrame,
    order: Order = DEFAULT,
    name: str = "rn",
    total: str | None = None,
    plan: Layout | None = None,
) -> DataFrame:
    """Add the 1-based position of each row in its key, and the number of rows of the key."""
    plan = plan or layout(df, order)
    first = df.columns
    df, rest = _pack(df, [*order.keys, *order.columns])
    if plan.single:
        out = df.withColumn(name, F.row_number().over(plan.window()).cast("bigint"))
        if total:
            out = out.withColumn(total, F.count(F.lit(1)).over(Window.partitionBy(*order.keys)))
        return _unpack(out, rest, first)
    out = plan.assign(df)
    out = out.withColumn(name, F.col("_lo") + F.row_number().over(plan.window()))
    if total:
        out = out.withColumn(total, F.col("_total"))
    return _unpack(out.drop("_blk", "_lo", "_total", "_halo"), rest, first)


# name -> (kind, column); kinds: sum, count, min, max, last, first (the last two skip nulls)
Spec = dict[str, tuple[str, Column]]

_IN_BLOCK = {
    "sum": F.sum,
    "count": F.count,
    "min": F.min,
    "max": F.max,
    "last": lambda c: F.last(c, ignorenulls=True),
    "first": lambda c: F.last(c, ignorenulls=True),  # over rows in reverse order
}


def running(
    df: DataFrame,
    specs: Spec,
    order: Order = DEFAULT,
    exclusive: bool = False,
    plan: Layout | None = None,
) -> DataFrame:
    """Running aggregates from the first row of the key to the current one, nulls skipped.

    `exclusive` leaves the current row out. Kind ``first`` looks the other way: the next non-null
    value at or after the current row.
    """
    plan = plan or layout(df, order)
    unbounded = Window.unboundedPreceding
    edge = 1 if exclusive else 0
    inputs = {name: f"_in_{name}" for name in specs}
    first = [c for c in df.columns if c not in specs]
    df = df.withColumns({inputs[n]: c for n, (_, c) in specs.items()}).select(*first, *inputs.values())
    df, rest = _pack(df, [*order.keys, *order.columns, *inputs.values()])
    kinds = {n: k for n, (k, _) in specs.items()}

    def local(window: WindowSpec, name: str) -> Column:
        return _IN_BLOCK[kinds[name]](F.col(inputs[name])).over(window.rowsBetween(unbounded, -edge))

    def local_window(name: str) -> WindowSpec:
        # Spark walks a frame up to the last row anew from every row, one from the first row once: look back in reverse order
        return plan.window(reverse=kinds[name] == "first")

    if plan.single:
        out = df.withColumns({n: local(local_window(n), n) for n in specs})
        return _unpack(out.drop(*inputs.values()), rest, first)

    keys = list(order.keys)
    spread = plan.assign(df)
    totals = []
    for name, kind in kinds.items():
        value = F.col(inputs[name])
        if kind in ("last", "first"):
            stamp = F.when(value.isNotNull(), order.stamp())
            pick = F.max_by if kind == "last" else F.min_by
            totals.append(pick(value, stamp).alias(f"_t_{name}"))
        else:
            totals.append(_IN_BLOCK[kind](value).alias(f"_t_{name}"))
    blocks = spread.groupBy(*keys, "_blk").agg(*totals)
    by_block = Window.partitionBy(*keys)
    prefix = {}
    for name, kind in kinds.items():
        frame = by_block.orderBy(F.col("_blk").desc() if kind == "first" else "_blk").rowsBetween(unbounded, -1)
        outer = "sum" if kind == "count" else kind
        prefix[f"_p_{name}"] = _IN_BLOCK[outer](F.col(f"_t_{name}")).over(frame)
    blocks = blocks.withColumns(prefix).select(*keys, "_blk", *prefix)
    if plan.n_cells <= BROADCAST_ROWS:
        blocks = F.broadcast(blocks)
    out = spread.join(blocks, [*keys, "_blk"], "left")
    merged = {}
    for name, kind in kinds.items():
        here, before = local(local_window(name), name), F.col(f"_p_{name}")
        if kind == "sum":
            both = F.coalesce(here + before, here, before)
        elif kind == "count":
            both = F.coalesce(here, F.lit(0)) + F.coalesce(before, F.lit(0))
        elif kind == "max":
            both = F.greatest(here, before)
        elif kind == "min":
            both = F.least(here, before)
        else:
            both = F.coalesce(here, before)
        merged[name] = both
    out = out.withColumns(merged)
    drop = [*inputs.values(), *prefix, "_blk", "_lo", "_total", "_halo"]
    return _unpack(out.drop(*drop), rest, first)


def counted(small: DataFrame) -> DataFrame:
    """A table that is expected to be small, such as one row per key, written once and counted.

    Up to `BROADCAST_ROWS` rows it is broadcast, so the rows of a hot key are not shuffled. Beyond that the join shuffles and AQE
    splits skewed keys.
    """
    small = cut_lineage(small)
    return F.broadcast(small) if small.count() <= BROADCAST_ROWS else small


def join_small(df: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join a table that is expected to be small (see `counted`)."""
    return df.join(counted(small), on, how)
