"""Timestamp units, buckets and order checks. Time is a bigint; microseconds are canonical."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from microbook.functions.quantiles import exact_quantiles
from microbook.plans.ordered import DEFAULT, Order, floor_to, over_rows, row_index

# Microseconds per unit, and the span 2020-01-01 to 2030-01-01 in seconds.
MICROS = {"us": 1, "ms": 1_000, "s": 1_000_000}
SPAN_SECONDS = (1_577_836_800, 1_893_456_000)


def unit_of(value: Column) -> Column:
    """Unit of a timestamp: inside 2020-2030 in that unit, else by magnitude, else ``unknown``."""
    x = value.cast("double")
    out = F.lit("unknown")
    for unit, least in (("s", 1e9), ("ms", 1e12), ("us", 1e15)):
        out = F.when(x > least, unit).otherwise(out)
    for unit in ("s", "ms", "us"):
        scale = float(1_000_000 // MICROS[unit])
        low, high = (float(s) * scale for s in SPAN_SECONDS)
        out = F.when(x.between(low, high), unit).otherwise(out)
    return F.when(x.isNull(), "unknown").otherwise(out)


def detect_unit(df: DataFrame, ts: str = "ts") -> str:
    """Unit of column `ts`, from the median of all its values; ``unknown`` without data.

    The bounds of the units cut the numbers into a dozen ranges. One aggregate counts each range and keeps its ends, which is all
    that the unit of the exact median needs.
    """
    if ts not in df.columns:
        return "unknown"
    cuts = {1e9, 1e12, 1e15} | {float(s) * (1_000_000 // MICROS[u]) for u in MICROS for s in SPAN_SECONDS}
    x = F.col("x")
    place = sum([(x >= c).cast("int") + (x > c).cast("int") for c in sorted(cuts)], F.lit(0))
    values = df.select(F.col(ts).cast("double").alias("x")).where(x.isNotNull())
    ranges = values.groupBy(place.alias("place")).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
    rows = sorted(ranges.collect(), key=lambda r: r.place)
    total = sum(r.n for r in rows)
    if not total:
        return "unknown"

    def holding(rank: int):
        for r in rows:
            if rank < r.n:
                return r
            rank -= r.n

    lower, upper = holding((total - 1) // 2), holding(total // 2)
    # both middle values lie in one range, or they are the ends of two that follow each other
    median = lower.low if lower is upper else (lower.high + upper.low) / 2
    return df.sparkSession.range(1).select(unit_of(F.lit(float(median)))).first()[0]


def detect_unit_by(df: DataFrame, keys: tuple[str, ...] = ("symbol",), ts: str = "ts") -> DataFrame:
    """Median timestamp and its unit per key, over all rows."""
    medians = exact_quantiles(df, ts, {"median_ts": 0.5}, keys)
    return medians.withColumn("ts_unit", unit_of(F.col("median_ts")))


def convert(value: Column, source: str, target: str) -> Column:
    """Change the unit of a bigint timestamp; dividing rounds down, also below zero."""
    if MICROS[source] >= MICROS[target]:
        return value * F.lit(MICROS[source] // MICROS[target])
    k = MICROS[target] // MICROS[source]
    return ((value - F.pmod(value, F.lit(k))) / k).cast("bigint")


def normalize_timestamp(
    df: DataFrame, ts: str = "ts", source: str | None = None, target: str = "us", both: bool = False
) -> DataFrame:
    """Bring `ts` to `target`; with `both`, add ts_us and ts_ms. Unknown units are left alone."""
    source = source or detect_unit(df, ts)
    if source == "unknown":
        return df
    df = df.withColumn(ts, convert(F.col(ts), source, target))
    if both:
        df = df.withColumn("ts_us", convert(F.col(ts), target, "us"))
        df = df.withColumn("ts_ms", convert(F.col("ts_us"), "us", "ms"))
    return df


def bucket_width(size: int, size_unit: str = "ms", ts_unit: str = "us") -> int:
    """A bucket size expressed in the unit of the timestamp."""
    return int(size * MICROS[size_unit] / MICROS[ts_unit])


def add_bucket(
    df: DataFrame, size: int, size_unit: str = "ms", ts: str = "ts",
    ts_unit: str | None = None, name: str = "bucket",
) -> DataFrame:
    """Add the start of the time bucket of each row."""
    ts_unit = ts_unit or detect_unit(df, ts)
    if ts_unit == "unknown":
        return df
    return df.withColumn(name, floor_to(F.col(ts), bucket_width(size, size_unit, ts_unit)))


def to_timestamp(micros: Column) -> Column:
    return F.timestamp_micros(micros)


def to_micros(timestamp: Column) -> Column:
    """Microseconds of a timestamp; one without time zone is read in the session zone (UTC)."""
    return F.unix_micros(timestamp.cast("timestamp"))


def order_violations(df: DataFrame, order: Order, first: int = 10) -> DataFrame:
    """Per key, rows whose `ts` lies below the previous row's; `order` is the arrival order.

    `order.ts` is the arrival position and `df.ts` the checked time. Returns the number of
    violations and the first positions (0-based).
    """
    keys = list(order.keys)
    placed = row_index(df, order, "_rn")
    placed = over_rows(
        placed, lambda d, w: d.withColumn("_bad", F.col("ts") < F.lag("ts").over(w)), order, back=1
    )
    bad = F.col("_bad")
    counts = placed.groupBy(*keys).agg(F.count_if(bad).cast("bigint").alias("violations"))
    smallest = row_index(placed.filter(bad), order, "_k").filter(F.col("_k") <= first)
    listed = smallest.groupBy(*keys).agg(
        F.sort_array(F.collect_list((F.col("_rn") - 1).cast("bigint"))).alias("positions")
    )
    empty = F.array().cast("array<bigint>")
    return (
        counts.join(listed, keys, "left")
        .withColumn("positions", F.coalesce("positions", empty))
        .withColumn("is_monotonic", F.col("violations") == 0)
    )
