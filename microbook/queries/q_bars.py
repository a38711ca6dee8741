"""Queries on time handling, bars and bucket aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from microbook.functions import timeutil
from microbook.functions.expr import price_key, to_double
from microbook.operators import bars
from microbook.plans.ordered import DEFAULT, Order
from microbook.queries.registry import query, snap_sql, snapped, with_ctes
from microbook.queries.tables import CLEAN, HOUR, LINE_ORDER, LINES, LINES_SQL, TRADES, clean_rows, lines, read, trades

BAR_SQL = """symbol, ts - ts % {w} as bucket, arg_min(price, ({o})) as open, max(price) as high, min(price) as low,
  arg_max(price, ({o})) as close, {vol}, {vwap}, count(*) as number_of_trades"""


def _bars(width: int, order: str) -> str:
    return BAR_SQL.format(
        w=width, o=order, vol=snap_sql("sum(qty)", "volume"),
        vwap=snap_sql("sum(price * qty) / nullif(sum(qty), 0)", "vwap"),
    )


@query("bars_trades", with_ctes(TRADES, f"select {_bars(HOUR, 'ts, seq')} from trades where price > 0 group by 1, 2"))
def bars_trades(spark, sf):
    """Hourly OHLCV from trades."""
    return snapped(bars.trade_bars(trades(spark, sf), HOUR), "volume", "vwap")


DAY = 24 * HOUR


@query("bars_lineitem", with_ctes(LINES_SQL, f"select {_bars(DAY, LINE_ORDER)} from lines where price > 0 group by 1, 2"))
def bars_lineitem(spark, sf):
    """Daily OHLCV of the large table."""
    return snapped(bars.trade_bars(lines(spark, sf), DAY, order=LINES), "volume", "vwap")


@query("bars_joined", with_ctes(TRADES + f""", b as (select {_bars(HOUR, 'ts, seq')} from trades where price > 0 group by 1, 2)""", """
select t.symbol, t.ts, t.seq, b.open, b.high, b.low, b.close, b.volume, b.vwap, b.number_of_trades
from trades t left join b on b.symbol = t.symbol and b.bucket = t.ts - t.ts % 3600000000"""))
def bars_joined(spark, sf):
    """The bar of its hour on every trade."""
    out = bars.with_bars(trades(spark, sf), HOUR, "price", "qty")
    return snapped(out, "volume", "vwap").drop("price", "qty", "buyer_is_maker")


@query("bars_null", with_ctes(TRADES, """select symbol, ts, seq, null::double as open, null::double as high, null::double as low,
null::double as close, null::double as volume, null::double as vwap, null::double as number_of_trades from trades"""))
def bars_null(spark, sf):
    """Null bars where no price column exists."""
    return bars.with_bars(trades(spark, sf).select("symbol", "ts", "seq"), HOUR)


SNAP_DAY = """select symbol, min(ts) as ts, arg_min(mid, (ts, seq)) as open, max(mid) as high, min(mid) as low,
 arg_max(mid, (ts, seq)) as close, count(*) as number_of_trades, {vol}, {vwap}
from (select *, (bid_px_01 + ask_px_01) / 2 as mid, {v} as v from book) group by symbol, ts - ts % 86400000000"""


@query("bars_snapshots", with_ctes(CLEAN, SNAP_DAY.format(
    v="taker_buy_vol + taker_sell_vol", vol=snap_sql("sum(v)", "volume"),
    vwap=snap_sql("sum(mid * v) / nullif(sum(v), 0)", "vwap"))))
def bars_snapshots(spark, sf):
    """Daily OHLCV from book snapshots."""
    df = clean_rows(spark, sf).withColumn("midprice", (F.col("bid_px_01") + F.col("ask_px_01")) / 2)
    out = bars.snapshot_bars(df, DAY, volumes=("taker_buy_vol", "taker_sell_vol"))
    return snapped(out, "volume", "vwap")


@query("bars_snapshots_no_volume", with_ctes(CLEAN, SNAP_DAY.format(
    v="0", vol="null::double as volume", vwap="null::double as vwap")))
def bars_snapshots_no_volume(spark, sf):
    """Without volume columns, volume and VWAP are null."""
    df = clean_rows(spark, sf).withColumn("midprice", (F.col("bid_px_01") + F.col("ask_px_01")) / 2)
    return bars.snapshot_bars(df, DAY, volumes=())


FLAT = """feats as (select symbol, ts, seq, bid_px_01, ask_px_01, bid_sz_01, ask_sz_01, last_trade_px, last_trade_qty,
  (bid_px_01 + ask_px_01) / 2 as midprice, ask_px_01 - bid_px_01 as spread,
  (bid_sz_01 - ask_sz_01) / (bid_sz_01 + ask_sz_01) as imbalance, bid_sz_01 - ask_sz_01 as ofi,
  (bid_sz_01 * ask_px_01 + ask_sz_01 * bid_px_01) / (bid_sz_01 + ask_sz_01) as microprice,
  taker_buy_vol as taker_buy_volume, taker_sell_vol as taker_sell_volume from book)"""
LASTS = ", ".join(f"arg_max({c}, (ts, seq)) as {c}" for c in
                  ("bid_px_01", "ask_px_01", "bid_sz_01", "ask_sz_01", "last_trade_px", "last_trade_qty"))


def _flat(spark, sf):
    b, a, bs, az = (F.col(c) for c in ("bid_px_01", "ask_px_01", "bid_sz_01", "ask_sz_01"))
    return clean_rows(spark, sf).select(
        "symbol", "ts", "seq", "bid_px_01", "ask_px_01", "bid_sz_01", "ask_sz_01", "last_trade_px", "last_trade_qty",
        ((b + a) / 2).alias("midprice"), (a - b).alias("spread"), ((bs - az) / (bs + az)).alias("imbalance"),
        (bs - az).alias("ofi"), ((bs * a + az * b) / (bs + az)).alias("microprice"),
        F.col("taker_buy_vol").alias("taker_buy_volume"), F.col("taker_sell_vol").alias("taker_sell_volume"),
    )


@query("bucket_aggregate_v1", with_ctes(CLEAN + ", " + FLAT, f"""select symbol, ts - ts % 86400000000 as ts, {LASTS},
 sum(taker_buy_volume) as taker_buy_volume, sum(taker_sell_volume) as taker_sell_volume,
 {snap_sql('avg(spread)', 'spread')}, {snap_sql('avg(imbalance)', 'imbalance')}, {snap_sql('avg(ofi)', 'ofi')}, {snap_sql('avg(microprice)', 'microprice')},
 arg_min(midprice, (ts, seq)) as open, max(midprice) as high, min(midprice) as low, arg_max(midprice, (ts, seq)) as close,
 sum(taker_buy_volume + taker_sell_volume) as volume,
 {snap_sql('sum(midprice * (taker_buy_volume + taker_sell_volume)) / nullif(sum(taker_buy_volume + taker_sell_volume), 0)', 'vwap')},
 count(*) as number_of_trades from feats group by 1, 2"""))
def bucket_aggregate_v1(spark, sf):
    """Daily aggregate by name pattern, first rule set."""
    out = bars.bucket_aggregate(_flat(spark, sf), DAY, version=1)
    return snapped(out, "spread", "imbalance", "ofi", "microprice", "vwap")


@query("bucket_aggregate_v2", with_ctes(CLEAN + ", " + FLAT, f"""select symbol, ts - ts % 86400000000 as ts, {LASTS},
 arg_max(midprice, (ts, seq)) as midprice, arg_max(microprice, (ts, seq)) as microprice,
 sum(taker_buy_volume) as taker_buy_volume, sum(taker_sell_volume) as taker_sell_volume,
 {snap_sql('avg(spread)', 'spread')}, {snap_sql('avg(imbalance)', 'imbalance')}, {snap_sql('avg(ofi)', 'ofi')},
 count(*) as tick_count from feats group by 1, 2"""))
def bucket_aggregate_v2(spark, sf):
    """Daily aggregate by name pattern, second rule set."""
    return snapped(bars.bucket_aggregate(_flat(spark, sf), DAY), "spread", "imbalance", "ofi")


@query("bucket_aggregate_sane", with_ctes(CLEAN + ", " + FLAT, f"""select symbol, ts - ts % 86400000000 as ts, {LASTS},
 arg_max(midprice, (ts, seq)) as midprice, arg_max(microprice, (ts, seq)) as microprice,
 max(taker_buy_volume) - min(taker_buy_volume) as taker_buy_volume,
 max(taker_sell_volume) - min(taker_sell_volume) as taker_sell_volume,
 {snap_sql('avg(spread)', 'spread')}, {snap_sql('avg(imbalance)', 'imbalance')}, sum(ofi) as ofi,
 arg_min(midprice, (ts, seq)) as open, max(midprice) as high, min(midprice) as low, arg_max(midprice, (ts, seq)) as close,
 sum(taker_buy_volume + taker_sell_volume) as volume,
 {snap_sql('sum(midprice * (taker_buy_volume + taker_sell_volume)) / nullif(sum(taker_buy_volume + taker_sell_volume), 0)', 'vwap')},
 count(*) as tick_count from feats group by 1, 2"""))
def bucket_aggregate_sane(spark, sf):
    """Daily aggregate that does not sum ratios or cumulative volumes, with OHLC."""
    out = bars.bucket_aggregate(_flat(spark, sf), DAY, policy="sane", with_ohlc=True)
    return snapped(out, "spread", "imbalance", "vwap")


@query("timestamp_unit", with_ctes(TRADES, """
select symbol, median_ts, case when median_ts between 1577836800000000 and 1893456000000000 then 'us' else 'other' end as ts_unit,
  case when median_ts / 1000 between 1577836800000 and 1893456000000 then 'ms' else 'other' end as ms_unit
from (select symbol, quantile_cont(ts, 0.5)::double as median_ts from trades group by 1)"""))
def timestamp_unit(spark, sf):
    """Median time of a symbol and its unit, in microseconds and converted to milliseconds."""
    t = trades(spark, sf)
    out = timeutil.detect_unit_by(t)
    ms = timeutil.unit_of(F.floor(F.col("median_ts") / 1000))
    return out.withColumn("ms_unit", ms)


@query("timestamp_convert", with_ctes(TRADES, """
select seq, ts as ts_us, ts // 1000 as ts_ms, ts // 1000000 as ts_s, ts // 1000 * 1000 as back_us from trades"""))
def timestamp_convert(spark, sf):
    """Microseconds to other units and back."""
    t = trades(spark, sf).select("seq", "ts")
    t = timeutil.normalize_timestamp(t, "ts", "us", "us", both=True)
    return t.select(
        "seq", "ts_us", "ts_ms", timeutil.convert(F.col("ts"), "us", "s").alias("ts_s"),
        timeutil.convert(F.col("ts_ms"), "ms", "us").alias("back_us"),
    )


@query("time_buckets", with_ctes(TRADES, """
select symbol, ts - ts % 3600000000 as bucket, count(*) as n_rows, count(distinct ts - ts % 60000000) as n_minutes
from trades group by 1, 2"""))
def time_buckets(spark, sf):
    """Rows per hour and occupied minutes per hour."""
    t = timeutil.add_bucket(trades(spark, sf), 3600, "s", ts_unit="us")
    t = timeutil.add_bucket(t, 60_000, "ms", ts_unit="us", name="minute")
    return t.groupBy("symbol", "bucket").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("minute").alias("n_minutes")
    )


@query("timestamp_datetime", with_ctes(TRADES, """
select seq, strftime(make_timestamp(ts), '%Y-%m-%d %H:%M:%S') as at, ts as micros from trades"""))
def timestamp_datetime(spark, sf):
    """Microseconds to a timestamp and back."""
    at = timeutil.to_timestamp(F.col("ts"))
    return trades(spark, sf).select(
        "seq", F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("at"), timeutil.to_micros(at).alias("micros")
    )


@query("timestamp_monotonicity", """
with a as (select event_type as symbol, user_id * 1000 + event_id % 7 as ts, event_id as seq from events),
b as (select *, row_number() over (partition by symbol order by seq) - 1 as p, lag(ts) over (partition by symbol order by seq) as before from a),
v as (select symbol, p, row_number() over (partition by symbol order by p) as k from b where ts < before)
select s.symbol, count(v.p) as violations, count(v.p) = 0 as is_monotonic,
  string_agg(case when v.k <= 10 then v.p::varchar end, ',' order by v.p) as positions
from (select distinct symbol from a) s left join v using (symbol) group by 1""")
def timestamp_monotonicity(spark, sf):
    """Times below their predecessor in arrival order, with the first ten positions."""
    e = read(spark, sf, "events").select(
        F.col("event_type").alias("symbol"), (F.col("user_id") * 1000 + F.col("event_id") % 7).alias("ts"),
        F.col("event_id").alias("seq"),
    )
    out = timeutil.order_violations(e, Order(("symbol",), "seq", ()))
    return out.withColumn("positions", F.concat_ws(",", F.col("positions").cast("array<string>")))


@query("scalar_functions", with_ctes(TRADES, f"""
select seq, cast(floor(price * 1e8::double) as bigint) as price_key, try_cast(case when seq % 5 = 0 then 'x' || seq else price::varchar end as double) as parsed,
 {snap_sql('ln(price + 1)', 'ln1')}, {snap_sql('sqrt(price)', 'root')}, abs(price - 50) as dist, sign(price - 50)::double as side,
 greatest(least(price, 80.0::double), 20.0::double) as clipped, {snap_sql('power(price, 2)', 'squared')}, upper(symbol) as symbol from trades"""))
def scalar_functions(spark, sf):
    """Fixed-point keys, tolerant parsing and the arithmetic in use."""
    from microbook.functions.expr import clip

    p = F.col("price")
    text = F.when(F.col("seq") % 5 == 0, F.concat(F.lit("x"), F.col("seq").cast("string"))).otherwise(p.cast("string"))
    out = trades(spark, sf).select(
        "seq", price_key(p).alias("price_key"), to_double(text).alias("parsed"), F.log1p(p).alias("ln1"),
        F.sqrt(p).alias("root"), F.abs(p - 50).alias("dist"), F.signum(p - 50).alias("side"),
        clip(p, F.lit(20.0), F.lit(80.0)).alias("clipped"), F.pow(p, F.lit(2.0)).alias("squared"),
        F.upper("symbol").alias("symbol"),
    )
    return snapped(out, "ln1", "root", "squared")
