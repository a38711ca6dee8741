"""Gaps, segments and leak-safe splits.

Split bounds are functions of the row number and the row count of a key (or segment), so assigning a
split is a projection once rows are numbered; no sorted copy and no per-split slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from microbook.functions.expr import step
from microbook.functions.quantiles import exact_quantiles
from microbook.plans.ordered import DEFAULT, Order, layout, over_rows, row_index, running
from microbook.session import cut_lineage


def with_gaps(df: DataFrame, bucket_us: int = 100_000, factor: float = 2.0, order: Order = DEFAULT, plan=None) -> DataFrame:
    """Add `step_us` and `is_gap`: the step to the previous row exceeds factor × bucket."""
    def build(d, w):
        d = d.withColumn("step_us", step(F.col(order.ts), w))
        return d.withColumn("is_gap", F.coalesce(F.col("step_us") > bucket_us * factor, F.lit(False)))

    return over_rows(df, build, order, back=1, plan=plan)


def gap_stats(df: DataFrame, bucket_us: int = 100_000, factor: float = 2.0, order: Order = DEFAULT) -> DataFrame:
    """Number, shortest, longest and median gap per key."""
    gaps = cut_lineage(with_gaps(df, bucket_us, factor, order).filter("is_gap").select(*order.keys, "step_us"))
    out = gaps.groupBy(*order.keys).agg(
        F.count(F.lit(1)).alias("n_gaps"), F.min("step_us").alias("min_gap_us"), F.max("step_us").alias("max_gap_us")
    )
    return out.join(exact_quantiles(gaps, "step_us", {"median_gap_us": 0.5}, order.keys), list(order.keys))


def with_segments(df: DataFrame, bucket_us: int = 100_000, factor: float = 2.0, order: Order = DEFAULT) -> DataFrame:
    """Add `segment_id`, the number of gaps before the row."""
    plan = layout(df, order)
    df = with_gaps(df, bucket_us, factor, order, plan)
    return running(df, {"segment_id": ("count", F.when(F.col("is_gap"), F.lit(1)))}, order, plan=plan)


def segments(segmented: DataFrame, min_rows: int = 100, order: Order = DEFAULT) -> DataFrame:
    """Start, end, rows and hours of each segment of at least `min_rows` rows."""
    out = segmented.groupBy(*order.keys, "segment_id").agg(
        F.min(order.ts).alias("start_ts"), F.max(order.ts).alias("end_ts"), F.count(F.lit(1)).alias("n_rows")
    )
    hours = (F.col("end_ts") - F.col("start_ts")) / F.lit(3.6e9)
    return out.filter(F.col("n_rows") >= min_rows).withColumn("duration_hours", hours)


def segment_split(
    segmented: DataFrame, train_ratio: float = 0.8, min_rows: int = 100, min_test_rows: int = 100, order: Order = DEFAULT
) -> DataFrame:
    """Rows of usable segments with `split` train or test; each segment is cut on its own."""
    keyed = order.by(*order.keys, "segment_id")
    df = row_index(segmented, keyed, "_rn", total="_n")
    train = F.floor(F.col("_n") * F.lit(train_ratio)).cast("bigint")
    df = df.filter((F.col("_n") >= min_rows) & (F.col("_n") - train >= min_test_rows))
    return df.withColumn("split", F.when(F.col("_rn") <= train, "train").otherwise("test")).drop("_rn", "_n")


def train_test(split: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The train and test rows of all segments."""
    return split.filter(F.col("split") == "train"), split.filter(F.col("split") == "test")


def split_summary(split: DataFrame, *keys: str) -> DataFrame:
    """Segments and train/test rows."""
    return split.groupBy(*keys).agg(
        F.count_distinct("segment_id").alias("n_segments"),
        F.count_if(F.col("split") == "train").alias("total_train_rows"),
        F.count_if(F.col("split") == "test").alias("total_test_rows"),
    )


Bounds = list[tuple[int, Column, Column, Column, Column]]


def _roles(bounds: Bounds) -> list[tuple[int, Column, Column]]:
    """(id, trains, tests) of each split for the row number `_rn`; a split without training rows has no test rows either."""
    rn = F.col("_rn")
    return [(i, (b > a) & (rn > a) & (rn <= b), (b > a) & (rn > c) & (rn <= d)) for i, a, b, c, d in bounds]


def _spread(df: DataFrame, splits: Bounds) -> DataFrame:
    """Copy each row to the splits it belongs to; `splits` are (id, train_from, train_to, test_from, test_to)."""
    options = [F.struct(F.lit(i).alias("fold"), F.when(trains, "train").when(tests, "test").alias("split")) for i, trains, tests in _roles(splits)]
    chosen = F.filter(F.array(*options), lambda s: s["split"].isNotNull())
    return df.withColumn("_s", F.explode(chosen)).select("*", "_s.fold", "_s.split").drop("_s", "_rn", "_n")


MOST_ROLES = 31


def _packed_roles(df: DataFrame, bounds: Bounds) -> DataFrame:
    """Add `roles`: bit 2i if the row trains split i, bit 2i + 1 if it tests it. Rows are not copied, and few numbers occur."""
    if len(bounds) > MOST_ROLES:
        raise ValueError(f"at most {MOST_ROLES} splits fit into one number")
    bits = F.lit(0).cast("bigint")
    for i, trains, tests in _roles(bounds):
        bits = bits + F.when(trains, 1 << 2 * i).when(tests, 2 << 2 * i).otherwise(0).cast("bigint")
    return df.withColumn("roles", bits).drop("_rn", "_n")


def walk_forward(df: DataFrame, n_splits: int = 5, test_size: float = 0.1, gap_rows: int = 0, order: Order = DEFAULT) -> DataFrame:
    """Expanding splits at the end of each key: `fold`, `split`; `gap_rows` before a test set are left out."""
    df = row_index(df, order, "_rn", total="_n")
    n = F.col("_n")
    test = F.floor(n * F.lit(test_size)).cast("bigint")
    bounds = []
    for i in range(n_splits):
        end = n - test * (n_splits - i - 1)
        bounds.append((i, F.lit(0), end - test - gap_rows, end - test, end))
    return _spread(df, bounds)


def _block_bounds(n_splits: int, train_window: int | None, test_window: int | None) -> Bounds:
    n = F.col("_n")
    test = F.lit(test_window).cast("bigint") if test_window else F.floor(n / F.lit(n_splits + 1)).cast("bigint")
    bounds = []
    for i in range(n_splits):
        end = n - test * (n_splits - i - 1)
        start = F.greatest(end - test - train_window, F.lit(0)) if train_window else F.lit(0)
        bounds.append((i, start, end - test, end - test, end))
    return bounds


def walk_forward_blocks(df: DataFrame, n_splits: int = 5, train_window: int | None = None, test_window: int | None = None, order: Order = DEFAULT) -> DataFrame:
    """Backtest splits: tests are the last n_splits blocks of n//(n_splits+1) rows, training before them."""
    return _spread(row_index(df, order, "_rn", total="_n"), _block_bounds(n_splits, train_window, test_window))


def block_roles(df: DataFrame, n_splits: int = 5, train_window: int | None = None, test_window: int | None = None, order: Order = DEFAULT) -> DataFrame:
    """The splits of `walk_forward_blocks` as a number per row, `roles`, without copies: bit 2i trains split i, bit 2i + 1 tests it."""
    return _packed_roles(row_index(df, order, "_rn", total="_n"), _block_bounds(n_splits, train_window, test_window))


def time_series_folds(df: DataFrame, n_splits: int = 5, order: Order = DEFAULT) -> DataFrame:
    """Expanding cross-validation folds with test blocks of n//(n_splits+1) rows."""
    return walk_forward_blocks(df, n_splits, order=order)


def chronological(df: DataFrame, train_ratio: float = 0.7, val_ratio: float = 0.15, order: Order = DEFAULT) -> DataFrame:
    """`split` train, val or test by position in time."""
    df = row_index(df, order, "_rn", total="_n")
    a = F.floor(F.col("_n") * F.lit(train_ratio)).cast("bigint")
    b = F.floor(F.col("_n") * F.lit(train_ratio + val_ratio)).cast("bigint")
    name = F.when(F.col("_rn") <= a, "train").when(F.col("_rn") <= b, "val").otherwise("test")
    return df.withColumn("split", name).drop("_rn", "_n")


def tail_validation(df: DataFrame, share: float = 0.15, order: Order = DEFAULT) -> DataFrame:
    """`is_validation` on the last `share` of each key."""
    df = row_index(df, order, "_rn", total="_n")
    first = F.col("_n") - F.floor(F.col("_n") * F.lit(share)).cast("bigint")
    return df.withColumn("is_validation", F.col("_rn") > first).drop("_rn", "_n")
