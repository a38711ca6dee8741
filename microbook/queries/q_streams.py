"""Queries that stream derived files to the end and read the result."""

from __future__ import annotations

from pyspark.sql import functions as F

from microbook.operators import normalize
from microbook.queries.q_features import ALL, ALL_NAMES, ALL_SELECT, ALL_SNAP
from microbook.queries.q_sources import fresh
from microbook.queries.q_training import STANDARD, TRAIN, scaling_table
from microbook.queries.registry import query, snap_sql, snapped, with_ctes
from microbook.queries.tables import CLEAN, HOUR, TRADES, clean_rows, stored_path, trades
from microbook.streaming import feature_stream, ingest, windows

LATE = "2 hours"


def _trade_stream(spark, sf):
    """The trade table as a stream with event time; the trigger takes what is there, in parallel."""
    source = stored_path(spark, sf, "trades", lambda: trades(spark, sf))
    return ingest.with_event_time(ingest.stream_table(spark, source), late=LATE)


def _ended_stream(spark, sf):
    """The trades followed by the end of the input: `ingest.end_marker` as the last file."""
    source = _source(spark, sf, "ended-trades", lambda: _land_trades(spark, sf))
    return ingest.with_event_time(ingest.stream_table(spark, source), late=LATE)


def _land_trades(spark, sf):
    path = fresh(spark, "ended-trades")
    rows = trades(spark, sf)
    rows.write.parquet(path)
    ingest.end_marker(rows, "ts", symbol="", price=1.0, qty=0.0).write.mode("append").parquet(path)
    return path


_SOURCES: dict[tuple[str, str, str], str] = {}


def _source(spark, sf, name, land) -> str:
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _SOURCES:
        _SOURCES[key] = land()
    return _SOURCES[key]


def _drained(spark, df, name):
    """Run a stream to its end and read what it wrote."""
    path = fresh(spark, name)
    ingest.drain(df, path, fresh(spark, f"{name}-checkpoint"))
    return spark.read.parquet(path)


@query("stream_ingest", with_ctes(TRADES, "select symbol, ts, seq, price, qty from trades"))
def stream_ingest(spark, sf):
    """Every file once, into a table."""
    return _drained(spark, _trade_stream(spark, sf), "ingested").select("symbol", "ts", "seq", "price", "qty")


@query("stream_bars", with_ctes(TRADES, f"""select symbol, ts - ts % {HOUR} as bucket, arg_min(price, (ts, seq)) as open, max(price) as high, min(price) as low, arg_max(price, (ts, seq)) as close,
 sum(qty) as volume, {snap_sql('sum(price * qty) / nullif(sum(qty), 0)', 'vwap')}, count(*) as number_of_trades from trades where price > 0 group by 1, 2"""))
def stream_bars(spark, sf):
    """Hourly bars; the end of the input emits the last ones."""
    return snapped(_drained(spark, windows.stream_bars(_ended_stream(spark, sf), "1 hour"), "bars"), "vwap")


@query("stream_segments", with_ctes(TRADES, f"""select symbol, min(ts) as start_ts, max(ts) as end_ts, count(*) as n_rows from (
 select *, sum(case when ts - before >= {HOUR} then 1 else 0 end) over (partition by symbol order by ts, seq rows unbounded preceding) as g
 from (select *, lag(ts) over (partition by symbol order by ts, seq) as before from trades)) group by symbol, g"""))
def stream_segments(spark, sf):
    """Session windows with a gap of an hour; the end of the input closes the last ones."""
    return _drained(spark, windows.stream_segments(_ended_stream(spark, sf), "1 hour"), "segments")


@query("stream_deduplicated", with_ctes(TRADES, "select symbol, ts, seq, price, qty from trades"))
def stream_deduplicated(spark, sf):
    """Every trade arrives twice and is kept once."""
    once = _trade_stream(spark, sf)
    twice = once.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    out = windows.drop_repeats(twice, "symbol", "seq")
    return _drained(spark, out, "deduplicated").select("symbol", "ts", "seq", "price", "qty")


COUNTED = TRADES + """, r as (select ts, seq from trades), old as (select ts, seq from r where seq % 50 = 0 and ts < (select max(ts) from r) - 10800000000),
al as (from r union all from old)"""


@query("stream_counters", with_ctes(COUNTED, """select count(*) as records, count(*) filter (seq % 3 = 0) as depth, count(*) filter (seq % 3 <> 0) as trades,
 count(*) filter (seq % 41 = 0) as broken, max(seq % 1000)::bigint as max_latency_us, (select count(*) from old) as late from al"""))
def stream_counters(spark, sf):
    """Counters that micro-batches report, of a stream with broken records, and with late ones that come after the watermark."""
    t = trades(spark, sf)
    kind = F.when(F.col("seq") % 3 == 0, "depth").otherwise("trade").alias("type")
    records = t.select("symbol", "seq", "ts", F.col("ts").alias("exchange_ts"), (F.col("ts") + F.col("seq") % 1000).alias("local_ts"), kind,
                       F.when(F.col("seq") % 41 == 0, "{").alias("_corrupt"))
    end = t.agg(F.max("ts").alias("end"))
    old = records.where("seq % 50 = 0").join(F.broadcast(end), F.col("ts") < F.col("end") - 3 * HOUR).drop("end").withColumn("symbol", F.lit("again"))
    source, out, checkpoint = (fresh(spark, f"counted-{x}") for x in ("records", "out", "checkpoint"))
    counters = windows.Counters()
    spark.streams.addListener(counters)
    try:
        for rows in (records, old):
            rows.write.mode("append").parquet(source)
            stream = ingest.with_event_time(windows.observed(ingest.stream_table(spark, source)), late=LATE)
            ingest.drain(windows.drop_repeats(stream, "symbol", "seq"), out, checkpoint)
            if not counters.ended.acquire(timeout=60):
                raise TimeoutError("the stream's last counters did not come")
    finally:
        spark.streams.removeListener(counters)
    names = ("records", "depth", "trades", "broken", "max_latency_us")
    return spark.createDataFrame([(*[counters.totals.get(n) for n in names], counters.late)], ", ".join(f"{n} bigint" for n in (*names, "late")))


@query("stream_scaled", with_ctes(CLEAN + ", " + TRAIN + ", st as (select " + ", ".join(f"avg({c}) as m_{c}, stddev_samp({c}) as s_{c}" for c in STANDARD) + " from tr)",
       "select symbol, ts, seq, " + ", ".join(snap_sql(f"({c} - m_{c}) / s_{c}", c, 4) for c in STANDARD) + " from tr, st"))
def stream_scaled(spark, sf):
    """A stream scaled with fitted statistics."""
    df = scaling_table(spark, sf).select("symbol", "ts", "seq", *STANDARD)
    manifest = normalize.fit_standard(df, STANDARD)
    source = _source(spark, sf, "scaled", lambda: _land(spark, df, "scaled-slices"))
    out = feature_stream.scale_stream(ingest.stream_table(spark, source), manifest)
    return snapped(_drained(spark, out, "scaled"), *STANDARD, digits=4)


def _land(spark, df, name):
    path = fresh(spark, name)
    ingest.land_in_slices(df, path, "ts")
    return path


@query("stream_features", with_ctes(CLEAN + ALL, ALL_SELECT))
def stream_features(spark, sf):
    """Features computed per micro-batch equal those of the whole table."""
    source = _source(spark, sf, "clean-slices", lambda: _land(spark, clean_rows(spark, sf), "clean-slices"))
    out, history = fresh(spark, "stream-features"), fresh(spark, "stream-history")
    stream = ingest.stream_table(spark, source, files_per_trigger=1)
    ingest.drain_batches(stream, lambda batch, i: feature_stream.feature_batch(batch, i, out, history), fresh(spark, "features-checkpoint"))
    return snapped(spark.read.parquet(out).select("symbol", "ts", "seq", *ALL_NAMES), *ALL_SNAP)
