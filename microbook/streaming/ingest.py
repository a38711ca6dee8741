"""Incremental ingestion with Structured Streaming: new files once, in time order, with checkpoints.

Files must appear in the landing folder complete (write elsewhere, then rename).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from microbook.functions.timeutil import to_timestamp
from microbook.session import shared_dir
from microbook.sources.raw import parse_lines


def stream_raw(spark: SparkSession, path: str, pattern: str = "*.jsonl*", files_per_trigger: int | None = None) -> DataFrame:
    """New raw lines, parsed into union records."""
    reader = spark.readStream.option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return parse_lines(reader.text(path))


def stream_table(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """New files of a Parquet table; its schema is taken from what is there."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def with_event_time(df: DataFrame, ts: str = "ts", late: str = "10 seconds") -> DataFrame:
    """Add `event_time` with a watermark: rows later than `late` are dropped and counted by Spark."""
    return df.withColumn("event_time", to_timestamp(F.col(ts))).withWatermark("event_time", late)


def end_marker(df: DataFrame, ts: str = "ts", **values: object) -> DataFrame:
    """One row a year after the last one, to be landed as the last file of a stream that ends.

    It moves the watermark past every open window, so the last ones come out. `values` should give it a key of its own and let it
    pass the query's filters; its own window never closes.
    """
    end = df.agg((F.max(ts) + F.lit(366 * 86_400_000_000)).alias(ts))
    return end.select(*[F.col(ts) if c == ts else F.lit(values.get(c)).cast(kind).alias(c) for c, kind in df.dtypes]).where(F.col(ts).isNotNull())


def drain(df: DataFrame, path: str, checkpoint: str, mode: str = "append", partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Process everything that has arrived, into Parquet, then stop."""
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def follow(df: DataFrame, path: str, checkpoint: str, every: str = "30 seconds") -> StreamingQuery:
    """Keep processing as files arrive."""
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every).start()


def drain_batches(df: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hand every micro-batch with its id to `each`, then stop."""
    query = df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def land_in_slices(
    df: DataFrame, path: str, ts: str, rows_per_slice: int = 2_000_000, at_least: int = 4
) -> int:
    """Write `df` as consecutive time slices of about equal size, one bounded file each.

    A stream over `path` that takes whole files meets the rows in time order, as it does behind a
    collector that rotates its files. One range-partitioned write cuts all slices; each is then moved on by itself, because
    a stream takes files by age. Returns the number of slices.
    """
    spark = df.sparkSession
    rows = df.count()
    n = max(at_least, -(-rows // rows_per_slice))
    if not rows:
        df.write.mode("append").parquet(path)
        return 1
    staged = f"{shared_dir(spark)}/slices-{uuid.uuid4().hex}"
    df.repartitionByRange(n, ts).withColumn("_slice", F.spark_partition_id()).write.partitionBy("_slice").parquet(staged)
    slices = spark.read.schema(StructType([*df.schema, StructField("_slice", IntegerType())])).parquet(staged)
    found = sorted(r[0] for r in slices.select("_slice").distinct().collect())
    for i in found:
        slices.filter(F.col("_slice") == i).drop("_slice").coalesce(1).write.mode("append").parquet(path)
    return len(found)
