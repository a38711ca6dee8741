"""Time bars and bucket aggregates.

All are hash aggregates with map-side combine: a hot bucket reaches its reducer as one partial row
per task. First and last values are chosen by (ts, ties), never by arrival.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from microbook.functions.expr import add_all, div
from microbook.functions.names import BAR_COLUMNS
from microbook.plans.ordered import DEFAULT, Order, floor_to


AT = "_at"


def _ohlc(price: Column) -> list[Column]:
    at = F.col(AT)
    return [
        F.min_by(price, at).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, at).alias("close"),
    ]


def trade_bars(
    df: DataFrame, interval_us: int, price: str = "price", qty: str = "qty", order: Order = DEFAULT
) -> DataFrame:
    """OHLCV, VWAP and trade count per (key, bucket) from rows with a positive price."""
    p, q = F.col(price), F.col(qty)
    volume = F.sum(q)
    return (
        df.filter(p.isNotNull() & (p > 0))
        .withColumns({"bucket": floor_to(F.col(order.ts), interval_us), AT: order.packed()})
        .groupBy(*order.keys, "bucket")
        .agg(
            *_ohlc(p),
            volume.alias("volume"),
            div(F.sum(p * q), volume).alias("vwap"),
            F.count(F.lit(1)).alias("number_of_trades"),
        )
    )


def null_bars(df: DataFrame) -> DataFrame:
    """Bar columns as nulls, for inputs without prices."""
    return df.withColumns({c: F.lit(None).cast("double") for c in BAR_COLUMNS})


def with_bars(
    df: DataFrame, interval_us: int, price: str = "last_trade_px", qty: str = "last_trade_qty",
    order: Order = DEFAULT,
) -> DataFrame:
    """Join the bar of its bucket to every row (left join; AQE splits a hot bucket)."""
    if price not in df.columns or qty not in df.columns:
        return null_bars(df)
    bars = trade_bars(df, interval_us, price, qty, order)
    keyed = df.withColumn("bucket", floor_to(F.col(order.ts), interval_us))
    return keyed.join(bars, [*order.keys, "bucket"], "left").drop("bucket")


def snapshot_bars(
    df: DataFrame, interval_us: int, price: str = "midprice",
    volumes: tuple[str, ...] = ("taker_buy_volume", "taker_sell_volume"), order: Order = DEFAULT,
) -> DataFrame:
    """OHLCV from price snapshots; ts is the first of the bucket, volume the sum of `volumes`."""
    if price not in df.columns:
        raise ValueError(f"price column {price!r} not found")
    present = [F.col(c) for c in volumes if c in df.columns]
    p = F.col(price)
    aggs = [F.min(order.ts).alias("_first"), *_ohlc(p)]
    aggs.append(F.count(F.lit(1)).alias("number_of_trades"))
    if present:
        total = add_all(present)
        aggs.append(F.sum(total).alias("volume"))
        aggs.append(div(F.sum(p * total), F.sum(total)).alias("vwap"))
    else:
        aggs += [F.lit(None).cast("double").alias(c) for c in ("volume", "vwap")]
    return (
        df.withColumns({"_bucket": floor_to(F.col(order.ts), interval_us), AT: order.packed()})
        .groupBy(*order.keys, "_bucket").agg(*aggs)
        .drop("_bucket").withColumnRenamed("_first", order.ts)
    )


# Name patterns that choose the aggregate of a column.
LAST_PREFIXES = ("bid_px", "ask_px", "bid_sz", "ask_sz", "last_trade")
LAST_PREFIXES_V2 = LAST_PREFIXES + ("midprice", "microprice")
MEAN_NAMES = ("ofi", "imbalance", "spread", "microprice")
MEAN_PARTS_V2 = ("ofi", "imbalance", "spread", "kyle", "vpin", "slope", "queue")

CUMULATIVE = ("taker_buy_vol", "taker_sell_vol", "taker_buy_volume", "taker_sell_volume")


def _rule(column: str, version: int) -> str | None:
    prefixes = LAST_PREFIXES if version == 1 else LAST_PREFIXES_V2
    if column.startswith(prefixes):
        return "last"
    if "vol" in column.lower():
        return "sum"
    if version == 1:
        return "mean" if column in MEAN_NAMES else None
    return "mean" if any(p in column.lower() for p in MEAN_PARTS_V2) else None


def _sane_rule(column: str) -> str:
    """Ratios and deviations average, cumulative volumes difference, everything else is last."""
    if column in CUMULATIVE:
        return "delta"
    if column.startswith(("ofi", "delta_")) and "cumulative" not in column:
        return "sum"
    if any(p in column for p in ("imbalance", "spread", "kyle", "vpin", "slope", "queue", "volatility")):
        return "mean"
    return "last"


def bucket_aggregate(
    df: DataFrame, interval_us: int, version: int = 2, policy: str = "reference",
    with_ohlc: bool | None = None, order: Order = DEFAULT,
) -> DataFrame:
    """One row per (key, bucket), the aggregate of each column chosen by its name.

    Version 1 keeps book and trade columns (last), sums every name with ``vol``, averages a few
    ratios and adds OHLCV of the mid price; version 2 also keeps mid and micro price, averages more
    names and counts rows (`tick_count`). Columns that match nothing are dropped. The rules sum
    volatilities and cumulative volumes; ``policy="sane"`` averages or differences those instead.
    """
    skip = {*order.keys, order.ts, *order.ties}
    at = F.col(AT)
    aggs: list[Column] = []
    for name, kind in df.dtypes:
        if name in skip or kind in ("string", "boolean"):
            continue
        rule = _rule(name, version) if policy == "reference" else _sane_rule(name)
        c = F.col(name)
        if rule == "last":
            aggs.append(F.max_by(c, at).alias(name))
        elif rule == "sum":
            aggs.append(F.coalesce(F.sum(c), F.lit(0).cast(kind)).alias(name))
        elif rule == "mean":
            aggs.append(F.avg(c).alias(name))
        elif rule == "delta":
            aggs.append((F.max(c) - F.min(c)).alias(name))
    ohlc = version == 1 if with_ohlc is None else with_ohlc
    if ohlc and "midprice" in df.columns:
        aggs += _ohlc(F.col("midprice"))
    takers = [F.col(c) for c in ("taker_buy_volume", "taker_sell_volume") if c in df.columns]
    if ohlc and takers:
        total = add_all(takers)
        aggs.append(F.coalesce(F.sum(total), F.lit(0.0)).alias("volume"))
        if "midprice" in df.columns:
            aggs.append(div(F.sum(F.col("midprice") * total), F.sum(total)).alias("vwap"))
    aggs.append(F.count(F.lit(1)).alias("number_of_trades" if version == 1 else "tick_count"))
    return (
        df.withColumns({"_bucket": floor_to(F.col(order.ts), interval_us), AT: order.packed()})
        .groupBy(*order.keys, "_bucket").agg(*aggs)
        .withColumnRenamed("_bucket", order.ts)
    )


def final_bars(raw: DataFrame) -> DataFrame:
    """Exchange-supplied bars that are closed, as numbers."""
    k = F.col("kline")
    numbers = {c: k[c].try_cast("double") for c in ("open", "high", "low", "close", "volume")}
    return (
        raw.filter((F.col("type") == "kline") & k["is_final"])
        .select("symbol", "exchange_ts", k["interval"].alias("interval"),
                *[v.alias(c) for c, v in numbers.items()],
                k["trades"].cast("bigint").alias("number_of_trades"))
    )


def reconcile_bars(left: DataFrame, right: DataFrame, columns: tuple[str, ...] = ("close", "volume")) -> DataFrame:
    """Bars of two sources side by side by (symbol, bucket), with the difference per column."""
    on = ["symbol", "bucket"]
    a = left.select(*on, *[F.col(c).alias(f"{c}_a") for c in columns])
    b = right.select(*on, *[F.col(c).alias(f"{c}_b") for c in columns])
    both = a.join(b, on, "full")
    return both.withColumns({f"{c}_diff": F.col(f"{c}_a") - F.col(f"{c}_b") for c in columns})
