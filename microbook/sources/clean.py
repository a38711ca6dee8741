"""The clean table: wide book rows as zstd Parquet by symbol and date, with a manifest table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from microbook.functions.timeutil import to_timestamp
from microbook.operators.book import to_wide

VERSION = "2.0"
ROW_GROUP_BYTES = 64 * 1024 * 1024


def _dated(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn("date", F.date_format(to_timestamp(F.col(ts)), "yyyy-MM-dd"))


def write(df: DataFrame, path: str, depth: int = 10, mode: str = "append", ts: str = "ts") -> None:
    """Write wide rows, or nested snapshots (which are widened)."""
    if "bids" in df.columns:
        df = to_wide(df, depth)
    writer = _dated(df, ts).hint("rebalance", "symbol", "date").write.mode(mode).partitionBy("symbol", "date")
    writer.option("compression", "zstd").option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _date_between(start: int, end: int) -> Column:
    low, high = (F.date_format(F.timestamp_micros(F.lit(t)), "yyyy-MM-dd") for t in (start, end))
    return F.col("date").between(low, high)


def read_range(spark: SparkSession, path: str, start: int, end: int, ts: str = "ts") -> DataFrame:
    """Rows with start <= ts <= end; dates prune partitions, ts prunes row groups."""
    df = read(spark, path)
    inside = F.col(ts).between(start, end)
    return df.filter(_date_between(start, end) & inside) if "date" in df.columns else df.filter(inside)


def manifest(df: DataFrame, interval_ms: int, depth: int, score: DataFrame | None = None) -> DataFrame:
    """Version, time range, depth, rows and quality per symbol: the metadata of a written table."""
    out = df.groupBy("symbol").agg(
        F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"), F.count(F.lit(1)).alias("row_count")
    )
    out = out.withColumns({
        "version": F.lit(VERSION), "snapshot_interval_ms": F.lit(interval_ms), "order_book_depth": F.lit(depth),
        "duration_sec": (F.col("end_ts") - F.col("start_ts")) / F.lit(1e6),
    })
    if score is not None:
        out = out.join(score.select("symbol", "all_passed", "quality_score"), "symbol", "left")
    return out


def write_manifest(rows: DataFrame, path: str) -> None:
    rows.withColumn("created_at", F.current_timestamp()).write.mode("append").parquet(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The latest metadata row of each symbol."""
    rows = spark.read.parquet(path)
    columns = [c for c in rows.columns if c != "symbol"]
    return rows.groupBy("symbol").agg(F.max_by(F.struct(*columns), "created_at").alias("m")).select("symbol", "m.*")
