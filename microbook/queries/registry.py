"""The registry of named queries: a Spark function and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from microbook.functions.expr import snap

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under `name`, with its SQL."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def with_ctes(ctes: str, select: str) -> str:
    return f"with {ctes}\n{select}"


def snapped(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Snap the named double columns so that summation order does not show."""
    return df.withColumns({c: snap(F.col(c), digits) for c in columns})


def snap_sql(expr: str, name: str | None = None, digits: int = 6) -> str:
    """The same snap in SQL."""
    scale = f"1e{digits}::double"
    return f"floor(({expr}) * {scale} + 0.5003::double) / {scale} as {name or expr}"
