"""Session settings and the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Row-count bound under which a table of a few narrow columns may be broadcast (about 10 MB).
BROADCAST_ROWS = 200_000

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.codegen.maxFields": "300",  # feature rows have over 100 columns
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings every operator assumes (UTC, AQE, skew joins)."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("microbook")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a fresh local one only on a local master without the setting."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    made = tempfile.mkdtemp(prefix="spark-microbook-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` to reliable storage once, so that every later use reads the same rows."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and read it back, with the size of its files.

    For rounds that feed each other: a checkpoint keeps the planner's guess of its size, a join guesses the product of its sides,
    and over some tens of rounds that number alone fills the driver's memory.
    """
    folder = f"{shared_dir(df.sparkSession)}/written-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
