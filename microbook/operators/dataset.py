"""Training sets: column selection, targets and sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from microbook.functions import names
from microbook.functions.expr import div
from microbook.plans.ordered import DEFAULT, Order, over_rows, row_index

FIT = 2**22  # values in the windows of one chunk: 32 MB


def output_columns(df: DataFrame, depth: int = 10, keep: tuple[str, ...] = ("symbol", "ts")) -> DataFrame:
    """Feature-table columns in their fixed order, those present only."""
    wanted = [*keep, *names.ladder_block(depth), *names.FEATURE_OUTPUT]
    return df.select(*[c for c in wanted if c in df.columns])


def select_features(df: DataFrame, features: list[str] | None = None, target: bool = True, keep: tuple[str, ...] = ("symbol", "ts")) -> DataFrame:
    """Keys, the wanted features that exist, and the target if there is one."""
    wanted = [*keep, *(features or names.TRAINING_FEATURES), *(["target"] if target else [])]
    return df.select(*[c for c in wanted if c in df.columns])


def create_target(
    df: DataFrame, kind: str = "return", horizon: int = 10, threshold_bps: float = 0.5,
    order: Order = DEFAULT, segment: str | None = None,
) -> DataFrame:
    """Look-ahead target: return in bps, price_delta, or direction (1 above the threshold, else 0).

    Null at the tail of each key. With `segment`, the look-ahead does not cross segment borders.
    """
    price = "midprice" if "midprice" in df.columns else "bid_px_01"
    if segment:
        order = order.by(*order.keys, segment)

    def build(d, w):
        p = F.col(price)
        change = F.lead(p, horizon).over(w) - p
        bps = div(change, p) * 10000
        targets = {"return": bps, "price_delta": change, "direction": (bps > threshold_bps).cast("tinyint")}
        return d.withColumn("target", targets[kind])

    if kind not in ("return", "price_delta", "direction"):
        raise ValueError(f"unknown target {kind!r}")
    return over_rows(df, build, order, ahead=horizon)


def _windows(
    df: DataFrame, row: dict[str, Column], build: Callable[[Column, Column], Column], length: int, stride: int, values: int, order: Order,
) -> DataFrame:
    """One row per window of `length` rows that starts at row 1, 1 + stride, ... of a key: the keys and `build(rows, start)`.

    Rows are put into chunks of consecutive starts, each with the rows its last window needs, and windows are slices of a chunk's
    array: the cost is that of the rows, of length / chunk copies of them, and of the windows kept. A chunk's windows hold `FIT`
    values at most, if one window does (it has `values`).
    """
    keys = list(order.keys)
    width = stride * max(1, min(4 * length // stride, FIT // max(values, 1)))
    numbered = row_index(df, order, "_rn")
    place = F.col("_rn") - 1
    chunks = F.sequence(F.floor(F.greatest(place - length + 1, F.lit(0)) / width).cast("bigint"), F.floor(place / width).cast("bigint"))
    spread = numbered.select(*keys, F.struct("_rn", *[c.alias(n) for n, c in row.items()]).alias("_row"), F.explode(chunks).alias("_chunk"))
    held = spread.groupBy(*keys, "_chunk").agg(F.sort_array(F.collect_list("_row")).alias("_rows"))
    last = F.least(F.lit(width), F.size("_rows") - length + 1)
    starts = F.when(last > 0, F.sequence(F.lit(1), last, F.lit(stride)))
    return held.select(*keys, F.explode(F.transform(starts, lambda s: build(F.col("_rows"), s))).alias("_w")).select(*keys, "_w.*")


def _doubles(columns: list[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in columns])


def forecast_sequences(
    df: DataFrame, features: list[str], targets: list[str], inputs: int = 60, outputs: int = 10,
    stride: int = 1, order: Order = DEFAULT,
) -> DataFrame:
    """One row per start: `x` (inputs × features), `y` (outputs × targets), start and end ts.

    Multiplies the data by `inputs`; keep it the last step and write it out.
    """
    length = inputs + outputs
    row = {"ts": F.col(order.ts), "x": _doubles(features), "y": _doubles(targets)}

    def build(rows: Column, s: Column) -> Column:
        return F.struct(
            F.get(rows, s - 1)["ts"].alias("start_ts"), F.get(rows, s + length - 2)["ts"].alias("end_ts"),
            F.slice(rows, s, inputs)["x"].alias("x"), F.slice(rows, s + inputs, outputs)["y"].alias("y"))

    return _windows(df, row, build, length, stride, inputs * len(features) + outputs * len(targets), order)


def labelled_sequences(
    df: DataFrame, features: list[str], label: str, length: int = 50, stride: int = 1, order: Order = DEFAULT
) -> DataFrame:
    """Windows of `length` rows labelled by their last row."""
    row = {"ts": F.col(order.ts), "x": _doubles(features), "y": F.col(label)}

    def build(rows: Column, s: Column) -> Column:
        end = F.get(rows, s + length - 2)
        return F.struct(end["ts"].alias("ts"), F.slice(rows, s, length)["x"].alias("x"), end["y"].alias("y"))

    return _windows(df, row, build, length, stride, length * len(features), order)
