"""Event-time operators: bars, sessions, duplicates and counters."""

from __future__ import annotations

from threading import Semaphore

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from microbook.functions.expr import div
from microbook.functions.timeutil import to_micros
from microbook.plans.ordered import DEFAULT, Order


def stream_bars(trades: DataFrame, interval: str, price: str = "price", qty: str = "qty", order: Order = DEFAULT) -> DataFrame:
    """OHLCV bars of a stream with `event_time`; a bar is emitted once the watermark passes its end."""
    p, q = F.col(price), F.col(qty)
    at = order.packed()
    bars = (
        trades.filter(p.isNotNull() & (p > 0))
        .groupBy(F.window("event_time", interval), *order.keys)
        .agg(
            F.min_by(p, at).alias("open"), F.max(p).alias("high"), F.min(p).alias("low"), F.max_by(p, at).alias("close"),
            F.sum(q).alias("volume"), F.sum(p * q).alias("_pq"), F.count(F.lit(1)).alias("number_of_trades"),
        )
    )
    return bars.select(
        *order.keys, to_micros(F.col("window.start")).alias("bucket"), "open", "high", "low", "close", "volume",
        div(F.col("_pq"), F.col("volume")).alias("vwap"), "number_of_trades",
    )


def stream_segments(df: DataFrame, gap: str, keys: tuple[str, ...] = ("symbol",), ts: str = "ts") -> DataFrame:
    """Continuous segments as session windows: rows less than `gap` apart belong together."""
    sessions = df.groupBy(F.session_window("event_time", gap), *keys).agg(
        F.min(ts).alias("start_ts"), F.max(ts).alias("end_ts"), F.count(F.lit(1)).alias("n_rows")
    )
    return sessions.drop("session_window")


def drop_repeats(df: DataFrame, *ids: str) -> DataFrame:
    """Keep the first record per id (trade id, update id) within the watermark."""
    return df.dropDuplicatesWithinWatermark(list(ids))


def observed(df: DataFrame, name: str = "quality") -> DataFrame:
    """Attach record counters, reported with the progress of every micro-batch."""
    return df.observe(
        name, F.count(F.lit(1)).alias("records"), F.count_if(F.col("type") == "depth").alias("depth"),
        F.count_if(F.col("type") == "trade").alias("trades"), F.count("_corrupt").alias("broken"),
        F.max(F.col("local_ts") - F.col("exchange_ts")).alias("max_latency_us"),
    )


class Counters(StreamingQueryListener):
    """Adds up the observed counters and the rows dropped as late over all micro-batches."""

    def __init__(self, name: str = "quality"):
        self.name = name
        self.totals: dict[str, int] = {}
        self.late = 0
        self.batches = 0
        self.ended = Semaphore(0)  # released once for every query that has ended and is counted

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.batches += 1
        self.late += sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        row = progress.observedMetrics.get(self.name)
        for key, value in (row.asDict() if row else {}).items():
            if value is None:
                continue
            add = max if key.startswith("max_") else int.__add__
            self.totals[key] = add(self.totals.get(key, value if key.startswith("max_") else 0), value)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.release()
