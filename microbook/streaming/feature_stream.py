"""Features and scaling over micro-batches.

A micro-batch is put behind the last rows of every symbol, kept in a small history table, so the
batch operators see the rows their frames need. History and output are written per batch id, which
makes a repeated batch overwrite itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from microbook.operators import features, normalize
from microbook.plans.ordered import DEFAULT, Order

KEEP = 2 * features.KYLE_WINDOW


def feature_batch(batch: DataFrame, batch_id: int, out: str, history: str, order: Order = DEFAULT, version: int = 2) -> None:
    """Write the features of one micro-batch to `out`, and the rows the next one needs to `history`."""
    spark = batch.sparkSession
    keys = list(order.keys)
    rows = batch.withColumns({"_old": F.lit(False), "_sum": F.lit(None).cast("double")})
    if batch_id > 0:
        rows = spark.read.parquet(f"{history}/batch_id={batch_id - 1}").unionByName(rows)
    done = features.all_features(rows, order, version)
    # cumulative flow restarts at the first kept row; shift it to where the last batch ended
    stamp = F.when(F.col("_old"), order.stamp())
    shift = done.groupBy(*keys).agg(
        (F.max_by("_sum", stamp) - F.coalesce(F.max_by("ofi_cumulative", stamp), F.lit(0.0))).alias("_shift")
    )
    done = done.join(shift, keys, "left")
    moved = F.col("ofi_cumulative") + F.coalesce("_shift", F.lit(0.0))
    total = F.when(F.col("_old"), F.col("_sum")).otherwise(F.coalesce(moved, F.lit(0.0)))
    done = done.withColumns({"ofi_cumulative": moved, "_total": total})
    fresh = done.filter(~F.col("_old")).drop("_old", "_sum", "_shift", "_total")
    fresh.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
    latest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order.columns])
    kept = done.withColumn("_k", F.row_number().over(latest)).filter(F.col("_k") <= KEEP)
    inputs = [c for c in batch.columns]
    kept.select(*inputs, F.lit(True).alias("_old"), F.col("_total").alias("_sum")).write.mode("overwrite").parquet(
        f"{history}/batch_id={batch_id}"
    )


def scale_stream(df: DataFrame, manifest: DataFrame) -> DataFrame:
    """Scale a stream with a saved manifest: a stateless projection."""
    return normalize.transform(df, manifest)
