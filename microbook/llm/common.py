"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from microbook.session import configure, shared_dir

SPACES = " \t\n\x0b\x0c\r"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table, with batches to Python small enough for long texts."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark.read.parquet(f"{sf}/{name}.parquet")


def stored(df: DataFrame, name: str) -> str:
    """Write `df` once to the shared folder and say where."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back: lineage ends at the files, which survive lost executors."""
    return df.sparkSession.read.schema(df.schema).parquet(stored(df, name))


def whole(text: str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def columns(df: DataFrame, **named: str) -> DataFrame:
    """Only the named columns, so that no other column of the input can clash."""
    return df.select(*[F.col(source).alias(name) for name, source in named.items()])
