"""Feature tables, their schema registry, predictions and saved manifests."""

from __future__ import annotations

import json

from fnmatch import fnmatch

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from microbook.functions.timeutil import to_timestamp
from microbook.operators.backtest import pnl_curve
from microbook.operators.features import SCHEMA_VERSION
from microbook.operators.normalize import MANIFEST
from microbook.plans.ordered import DEFAULT, Order

MAX_SPREAD_BPS = 10_000.0


def write(df: DataFrame, path: str, mode: str = "append", partitioned: bool = True) -> dict:
    """Write features; returns rows, the largest spread and warnings, observed during the write."""
    seen = Observation("features")
    spread = F.max("spread_bps") if "spread_bps" in df.columns else F.max(F.lit(None).cast("double"))
    df = df.observe(seen, F.count(F.lit(1)).alias("rows"), spread.alias("max_spread_bps"))
    out = df
    if partitioned and {"symbol", "ts"} <= set(df.columns):
        out = df.withColumn("date", F.date_format(to_timestamp(F.col("ts")), "yyyy-MM-dd"))
        out = out.hint("rebalance", "symbol", "date")
        writer = out.write.mode(mode).partitionBy("symbol", "date")
    else:
        writer = out.write.mode(mode)
    writer.option("compression", "zstd").parquet(path)
    stats = dict(seen.get)
    stats["warnings"] = []
    if "midprice" not in df.columns:
        stats["warnings"].append("midprice missing")
    if (stats["max_spread_bps"] or 0) > MAX_SPREAD_BPS:
        stats["warnings"].append("spread above limit")
    return stats


def read(spark: SparkSession, path: str) -> DataFrame:
    """All feature files; columns that only some files have are null elsewhere."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def read_range(spark: SparkSession, path: str, start: int, end: int) -> DataFrame:
    return read(spark, path).filter(F.col("ts").between(start, end))


def schema(spark: SparkSession, path: str) -> dict[str, str]:
    return dict(read(spark, path).dtypes)


def discover(spark: SparkSession, path: str) -> DataFrame:
    """Normalised feature files if there are any, else plain ones: those of the folder itself, else those at every depth below it.

    A table that Spark wrote is a folder whose name fits; files inside it are not looked at one by one.
    """
    context = spark.sparkContext
    root = context._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(context._jsc.hadoopConfiguration())
    base = fs.makeQualified(root).toString().rstrip("/")
    names: list[list[str]] = []
    listed = fs.listFiles(root, True) if fs.exists(root) else None
    while listed is not None and listed.hasNext():
        names.append(listed.next().getPath().toString()[len(base) + 1:].split("/"))
    for pattern in ("normalized_features_*.parquet", "features_*.parquet"):
        found = {(i, "/".join(parts[:i + 1])) for parts in names
                 if (i := next((i for i, part in enumerate(parts) if fnmatch(part, pattern)), None)) is not None}
        if found:
            top = [name for depth, name in found if depth == 0]
            paths = sorted(f"{base}/{name}" for name in top or [name for _, name in found])
            return spark.read.option("mergeSchema", "true").parquet(*paths)
    raise ValueError(f"no feature files in {path}")


def concat(*frames: DataFrame) -> DataFrame:
    """Union by name; columns absent from a frame are null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def sorted_by_time(df: DataFrame) -> DataFrame:
    """Total order by symbol and time: a range shuffle, for sinks that need it."""
    return df.orderBy(*[c for c in ("symbol", "ts", "seq") if c in df.columns])


def schema_entries(df: DataFrame, version: str = SCHEMA_VERSION) -> DataFrame:
    """Registry rows (version, position, name, dtype) of a table."""
    rows = [(version, i, name, kind) for i, (name, kind) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "version string, position int, name string, dtype string")


def schema_drift(old: DataFrame, new: DataFrame) -> DataFrame:
    """Columns whose name or type exists on one side only."""
    on = ["name", "dtype"]
    gone = old.join(new, on, "left_anti").select(*on, F.lit("removed").alias("change"))
    return gone.unionByName(new.join(old, on, "left_anti").select(*on, F.lit("added").alias("change")))


def inspect(df: DataFrame, rows: int = 5) -> dict[str, DataFrame]:
    """First and last rows by time, summary statistics and types."""
    order = [c for c in ("ts", "seq") if c in df.columns] or [df.columns[0]]
    kinds = df.sparkSession.createDataFrame(df.dtypes, "name string, dtype string")
    return {
        "head": df.orderBy(*order).limit(rows), "tail": df.orderBy(*[F.desc(c) for c in order]).limit(rows),
        "describe": df.summary("count", "mean", "stddev", "min", "max"), "dtypes": kinds,
    }


def save_predictions(df: DataFrame, path: str, actual: str = "y", predicted: str = "y_pred") -> None:
    """ts, y_true, y_pred and residual as Parquet."""
    y, p = F.col(actual), F.col(predicted)
    keys = [c for c in ("symbol", "fold") if c in df.columns]
    df.select(*keys, "ts", y.alias("y_true"), p.alias("y_pred"), (y - p).alias("residual")).write.mode("overwrite").parquet(path)


def save_curve(folds: DataFrame, path: str, order: Order = DEFAULT) -> None:
    """A profit curve over folds as CSV with a header: keys, split (from 1), idx, cumulative_pnl going on from fold to fold."""
    curve = pnl_curve(folds, order=order).select(*order.keys, (F.col("fold") + 1).alias("split"), "idx", "cumulative_pnl")
    curve.write.mode("overwrite").option("header", "true").csv(path)


def save_manifest(manifest: DataFrame, path: str, config: dict | None = None) -> None:
    """Scaler statistics as JSON lines, with the preprocessing choices beside them."""
    manifest.write.mode("overwrite").json(f"{path}/stats")
    spark = manifest.sparkSession
    spark.createDataFrame([(json.dumps(config or {}),)], "value string").write.mode("overwrite").text(f"{path}/config")


def load_manifest(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    config = spark.read.text(f"{path}/config").first()
    return spark.read.schema(MANIFEST).json(f"{path}/stats"), json.loads(config[0]) if config else {}
