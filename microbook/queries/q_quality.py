"""Queries on cleaning and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from microbook.functions.names import ladder
from microbook.operators import bars, quality
from microbook.plans.ordered import DEFAULT, Order
from microbook.queries.q_features import MICRO, MID, roll_sql
from microbook.queries.registry import query, snap_sql, snapped, with_ctes
from microbook.queries.tables import CLEAN, HOUR, PREDICTIONS, SNAPSHOTS, TRADES, clean_rows, read, snapshots, trades

GAP = 2 * HOUR  # hours apart is normal in this data; two hours count as a gap

FLAGS = """st as (select *, case when ts <= 0 then 'timestamp' when bid_px_01 is null or ask_px_01 is null then 'price'
   when bid_px_01 < 96 or ask_px_01 < 96 or bid_px_01 > 105 or ask_px_01 > 105 then 'price'
   when bid_px_01 >= ask_px_01 then 'spread' when (ask_px_01 - bid_px_01) / bid_px_01 > 0.02::double then 'spread' end as stat from {src}),
sv as (select *, max(case when stat is null then ts end) over (partition by symbol order by {ord} rows between unbounded preceding and 1 preceding) as seen from st),
flagged as (select *, case when ts <= 0 then 'timestamp' when ts < seen then 'timestamp' else stat end as reject_reason,
  coalesce(ts > 0 and ts - seen > {gap}, false) as stale from sv)"""
LIMITS = {"max_spread_pct": 0.02, "min_price": 96.0, "max_price": 105.0, "max_staleness_us": GAP}

# arrival order in which some snapshots come late and some carry no time
SHUFFLED = SNAPSHOTS + """,
arr as (select * exclude (ts), case when seq % 101 = 0 then 0 else ts end as ts, pos + case when seq % 7 = 0 then 60 else 0 end as arrival from snaps)"""


def _shuffled(spark, sf):
    s = snapshots(spark, sf)
    return s.withColumns({
        "ts": F.when(F.col("seq") % 101 == 0, 0).otherwise(F.col("ts")).cast("bigint"),
        "arrival": F.col("pos") + F.when(F.col("seq") % 7 == 0, 60).otherwise(0),
    })


ARRIVE = Order(("symbol",), "arrival", ("seq",), cell=3600)


@query("clean_flags", with_ctes(SHUFFLED + ", " + FLAGS.format(src="arr", ord="arrival, seq", gap=GAP),
                                "select symbol, seq, reject_reason, stale from flagged"))
def clean_flags(spark, sf):
    """First failing check and stale flag, in arrival order."""
    return quality.clean_flags(_shuffled(spark, sf), order=ARRIVE, time="ts", **LIMITS).select("symbol", "seq", "reject_reason", "stale")


@query("clean_flags_blocks", with_ctes(SHUFFLED + ", " + FLAGS.format(src="arr", ord="arrival, seq", gap=GAP),
                                       "select symbol, seq, reject_reason, stale from flagged"))
def clean_flags_blocks(spark, sf):
    """The same with blocks of 128 rows."""
    return quality.clean_flags(_shuffled(spark, sf), order=ARRIVE.blocks(128), time="ts", **LIMITS).select("symbol", "seq", "reject_reason", "stale")


@query("cleaning_stats", with_ctes(SHUFFLED + ", " + FLAGS.format(src="arr", ord="arrival, seq", gap=GAP), f"""select symbol, count(*) as total_snapshots,
 count(*) filter (where reject_reason is null) as valid_snapshots, count(*) filter (where reject_reason = 'timestamp') as invalid_timestamps,
 count(*) filter (where reject_reason = 'price') as invalid_prices, count(*) filter (where reject_reason = 'spread') as invalid_spreads,
 count(*) filter (where stale) as stale_snapshots, {snap_sql("count(*) filter (where reject_reason is null)::double / count(*)", "acceptance_rate")}
 from flagged group by 1"""))
def cleaning_stats(spark, sf):
    """Reject counts and acceptance rate."""
    flagged = quality.clean_flags(_shuffled(spark, sf), order=ARRIVE, time="ts", **LIMITS)
    return snapped(quality.cleaning_stats(flagged, "symbol"), "acceptance_rate")


@query("outliers_iqr", """select event_id, value, value >= q1 - 0.2::double * (q3 - q1) and value <= q3 + 0.2::double * (q3 - q1) as is_valid
from events, (select quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3 from events)""")
def outliers_iqr(spark, sf):
    """Inside the quartile fences."""
    return quality.outlier_mask(read(spark, sf, "events").select("event_id", "value"), "value", "iqr", 0.2)


@query("outliers_zscore", """select event_id, value, abs((value - m) / s) <= 1.5 as is_valid
from events, (select avg(value) as m, stddev_pop(value) as s from events)""")
def outliers_zscore(spark, sf):
    """Within 1.5 population deviations."""
    return quality.outlier_mask(read(spark, sf, "events").select("event_id", "value"), "value", "zscore", 1.5)


@query("fill_limited", with_ctes(TRADES + f""",
h as (select *, case when seq % 3 = 0 then price end as x, coalesce(ts - lag(ts) over w > 1800000000, false) as brk from trades window w as (partition by symbol order by ts, seq)),
i as (select *, sum(case when brk then 1 else 0 end) over (partition by symbol order by ts, seq rows unbounded preceding) as isl from h)""",
"select symbol, ts, seq, last_value(x ignore nulls) over (partition by symbol, isl order by ts, seq rows between unbounded preceding and current row) as x from i"))
def fill_limited(spark, sf):
    """Forward fill while steps stay within half an hour."""
    df = trades(spark, sf).select("symbol", "ts", "seq", F.when(F.col("seq") % 3 == 0, F.col("price")).alias("x"))
    return quality.forward_fill_gaps(df, "x", 1_800_000_000)


INV = " + ".join(
    [f"sum(case when {a} < {b} and {b} > 0 then 1 else 0 end)" for a, b in zip(ladder("bid", "px", 10), ladder("bid", "px", 10)[1:])]
    + [f"sum(case when {a} > {b} and {b} > 0 then 1 else 0 end)" for a, b in zip(ladder("ask", "px", 10), ladder("ask", "px", 10)[1:])])
# the report sees a ladder with two levels swapped on every 13th row and a negative size on every 17th
DIRTY = SNAPSHOTS + """,
dirty as (select * replace (case when seq % 13 = 0 then bid_px_02 else bid_px_01 end as bid_px_01,
  case when seq % 13 = 0 then bid_px_01 else bid_px_02 end as bid_px_02, case when seq % 17 = 0 then -1.0::double else bid_sz_03 end as bid_sz_03) from snaps),
r1 as (select *, ts - lag(ts) over w as dt, abs((""" + MID + """) / lag(""" + MID + """) over w - 1) as j0,
  abs((""" + MID + """ - lag(""" + MID + """) over w) / nullif(lag(""" + MID + """) over w, 0) * 100) as jump,
  bid_sz_01 - lag(bid_sz_01) over w as db, ask_sz_01 - lag(ask_sz_01) over w as da from dirty window w as (partition by symbol order by pos)),
r2 as (select *, """ + roll_sql("sum", "db", 10) + " as sb, " + roll_sql("sum", "da", 10) + " as sa from r1)"
NEG = " or ".join(f"coalesce({c} < 0, false)" for s in ("bid", "ask") for c in ladder(s, "sz", 10)) + " or coalesce(taker_buy_vol < 0, false) or coalesce(taker_sell_vol < 0, false)"
REPORT = DIRTY + f""",
one as (select symbol, count(*) as n, count(*) filter (where bid_px_01 >= ask_px_01) as crossed, count(*) filter (where {NEG}) as neg,
  count(*) filter (where dt < 0) as back, count(*) filter (where jump > 1.0) as jumps,
  count(*) filter (where (ask_px_01 - bid_px_01) / ({MID}) * 10000 > 100) as wide, ({INV})::bigint as inverted,
  count(*) filter (where abs(sb) > bid_sz_01 * 2 or abs(sa) > ask_sz_01 * 2) as odd, count(*) filter (where dt > {GAP}) as gaps, max(dt) as max_gap,
  min(ts) filter (where bid_px_01 >= ask_px_01) as first_crossed, max(jump) as max_jump,
  max((ask_px_01 - bid_px_01) / ({MID}) * 10000) as max_spread, avg((ask_px_01 - bid_px_01) / ({MID}) * 10000) as mean_spread from r2 group by 1),
checks as (
  select symbol, 'no_crossed_book' as check_name, crossed as f, n, false as info from one union all
  select symbol, 'no_negative_volumes', neg, n, false from one union all
  select symbol, 'monotonic_timestamps', back, n, false from one union all
  select symbol, 'midprice_stability', jumps, n, false from one union all
  select symbol, 'spread_bounds', wide, n, false from one union all
  select symbol, 'price_levels_ordered', inverted, n, false from one union all
  select symbol, 'spoofing_detection', 0, n, true from one)"""


def _dirty(spark, sf):
    swap = F.col("seq") % 13 == 0
    return snapshots(spark, sf).withColumns({
        "bid_px_01": F.when(swap, F.col("bid_px_02")).otherwise(F.col("bid_px_01")),
        "bid_px_02": F.when(swap, F.col("bid_px_01")).otherwise(F.col("bid_px_02")),
        "bid_sz_03": F.when(F.col("seq") % 17 == 0, -1.0).otherwise(F.col("bid_sz_03")),
    })


def _report(spark, sf, **options):
    return quality.book_report(_dirty(spark, sf).drop("pos"), max_jump_pct=1.0, max_gap_us=GAP, **options)


@query("quality_report", with_ctes(REPORT, f"""select symbol, check_name, f = 0 or info as valid, f::bigint as failed_count, n as total_count,
 {snap_sql('(n - f) / n::double', 'pass_rate')} from checks"""))
def quality_report(spark, sf):
    """All checks, a row each, with pass rates."""
    out = _report(spark, sf).select("symbol", "check_name", "valid", "failed_count", "total_count", "pass_rate")
    return snapped(out, "pass_rate")


@query("quality_details", with_ctes(REPORT, f"""select symbol, check_name, key, {snap_sql('value', 'value')} from (
 select symbol, 'no_crossed_book' as check_name, 'first_crossed_ts' as key, first_crossed::double / 1e9 as value from one union all
 select symbol, 'monotonic_timestamps', 'large_gaps', gaps / 1e9 from one union all
 select symbol, 'monotonic_timestamps', 'max_gap_us', max_gap / 1e9 from one union all
 select symbol, 'midprice_stability', 'max_jump_pct', max_jump / 1e9 from one union all
 select symbol, 'midprice_stability', 'threshold_pct', 1.0 / 1e9 from one union all
 select symbol, 'spread_bounds', 'max_spread_bps', max_spread / 1e9 from one union all
 select symbol, 'spread_bounds', 'mean_spread_bps', mean_spread / 1e9 from one union all
 select symbol, 'spoofing_detection', 'suspicious_patterns', odd / 1e9 from one union all
 select symbol, 'spoofing_detection', 'window_size', 10 / 1e9 from one)"""))
def quality_details(spark, sf):
    """Figures behind the checks, in billionths."""
    out = _report(spark, sf).select("symbol", "check_name", F.explode("details").alias("key", "value"))
    return snapped(out.withColumn("value", F.col("value") / 1e9), "value")


@query("quality_score", with_ctes(REPORT, f"""select symbol, bool_and(f = 0 or info) as all_passed,
 {snap_sql('avg((n - f) / n::double)', 'quality_score')}, max(n) as total_rows from checks group by 1"""))
def quality_score(spark, sf):
    """Mean pass rate per symbol."""
    return snapped(quality.report_score(_report(spark, sf), "symbol"), "quality_score")


# raw lines made from trades: most are valid, some miss a field, some are broken
RAW_REASON = """case seq % 11 when 0 then 'JSON parse error' when 1 then 'missing required field: symbol' when 2 then 'missing trade field: price'
 when 3 then 'unknown message type: other' when 4 then 'invalid bid format' when 5 then 'invalid ask values' when 6 then 'missing required field: asks' end"""


def raw_lines(spark, sf):
    """JSON lines of trade and depth records, every eleventh of each kind faulty."""
    t = trades(spark, sf)
    text = lambda c: F.col(c).cast("string")
    head = lambda kind: [F.col("ts").alias("exchange_ts"), F.col("ts").alias("local_ts"), F.lit(kind).alias("type")]
    sym = F.col("symbol").alias("symbol")
    full = F.struct(F.col("seq").alias("trade_id"), text("price").alias("price"), text("qty").alias("quantity"), F.col("buyer_is_maker").alias("buyer_is_maker"))
    short = F.struct(F.col("seq").alias("trade_id"), text("qty").alias("quantity"))
    level = F.array(F.array(text("price"), text("qty"))).alias("bids")
    asks = level.alias("asks")
    thin = F.array(F.array(text("price"))).alias("bids")
    words = F.array(F.array(text("price"), F.lit("many"))).alias("asks")
    good_trade = F.to_json(F.struct(*head("trade"), sym, full.alias("trade")))
    kind = F.col("seq") % 11
    line = (
        F.when(kind == 0, F.substring(good_trade, 1, 40))
        .when(kind == 1, F.to_json(F.struct(*head("trade"), full.alias("trade"))))
        .when(kind == 2, F.to_json(F.struct(*head("trade"), sym, short.alias("trade"))))
        .when(kind == 3, F.to_json(F.struct(*head("other"), sym)))
        .when(kind == 4, F.to_json(F.struct(*head("depth"), sym, thin, asks)))
        .when(kind == 5, F.to_json(F.struct(*head("depth"), sym, level, words)))
        .when(kind == 6, F.to_json(F.struct(*head("depth"), sym, level)))
        .when(kind == 7, F.to_json(F.struct(*head("depth"), sym, level, asks)))
        .when(kind == 8, F.to_json(F.struct(F.struct(F.lit("2.0").alias("version")).alias("_header"))))
        .otherwise(good_trade)
    )
    return t.select("seq", line.alias("line"))


@query("raw_validation", f"select event_id as seq, {RAW_REASON.replace('seq', 'event_id')} as reason from events")
def raw_validation(spark, sf):
    """Reason per raw line."""
    return raw_lines(spark, sf).select("seq", quality.message_reason(F.col("line")).alias("reason"))


@query("raw_validation_stats", f"""select count(*) - count(r) as valid_count, count(r) as invalid_count, count(*) as total_count,
 {snap_sql('(count(*) - count(r)) / count(*)::double', 'valid_rate')}, count(distinct r) as unique_errors from (select {RAW_REASON.replace('seq', 'event_id')} as r from events)""")
def raw_validation_stats(spark, sf):
    """Counts over the raw lines."""
    checked = raw_lines(spark, sf).select(quality.message_reason(F.col("line")).alias("reason"))
    return snapped(quality.message_stats(checked), "valid_rate")


FEATS = f"""fb as (select symbol, ts, seq, case when seq % 19 = 0 then null else {MID} end as midprice, ask_px_01 - bid_px_01 as spread,
  {MICRO} as microprice, bid_sz_01 - ask_sz_01 as ofi, bid_px_01, ask_px_01, taker_buy_vol as taker_buy_volume, taker_sell_vol as taker_sell_volume from book)"""


def _feats(spark, sf):
    b, a, bs, az = (F.col(c) for c in ("bid_px_01", "ask_px_01", "bid_sz_01", "ask_sz_01"))
    return clean_rows(spark, sf).select(
        "symbol", "ts", "seq", F.when(F.col("seq") % 19 != 0, (b + a) / 2).alias("midprice"), (a - b).alias("spread"),
        ((bs * a + az * b) / F.nullif(bs + az, F.lit(0.0))).alias("microprice"), (bs - az).alias("ofi"), "bid_px_01", "ask_px_01",
        F.col("taker_buy_vol").alias("taker_buy_volume"), F.col("taker_sell_vol").alias("taker_sell_volume"),
    )


STEPS = "stp as (select *, ts - lag(ts) over (partition by symbol order by ts, seq) as dt from fb)"
FILE = f"""select symbol, count(*) as rows, min(ts) as ts_min, max(ts) as ts_max, count(*) filter (where dt < 0) as ts_violations,
 {snap_sql('count(*) filter (where midprice is null) / count(*)::double * 100', 'midprice_null_pct')}, {snap_sql('avg(spread)', 'spread_mean')},
 count(*) filter (where spread < 0) as negative_spreads, count(*) filter (where taker_buy_volume < 0) as negative_taker_buy_volume,
 count(*) filter (where taker_sell_volume < 0) as negative_taker_sell_volume, count(distinct ts // 3600000000) as actual_buckets,
 (max(ts) - min(ts)) // 3600000000 + 1 as expected_buckets, false as too_many_buckets, 'us' as ts_unit,
 count(*) filter (where spread < 0) = 0 as valid from stp group by 1"""


@query("feature_file_report", with_ctes(CLEAN + ", " + FEATS + ", " + STEPS, FILE))
def feature_file_report(spark, sf):
    """Per-group statistics of a feature table."""
    return snapped(quality.file_report(_feats(spark, sf), HOUR), "midprice_null_pct", "spread_mean")


@query("feature_directory_summary", with_ctes(CLEAN + ", " + FEATS + ", " + STEPS, f"""select count(*) as total_files,
 count(*) filter (where valid) as valid_files, sum(rows)::bigint as total_rows, count(*) filter (where ts_violations > 0) as total_warnings from ({FILE})"""))
def feature_directory_summary(spark, sf):
    """Roll-up over groups."""
    return quality.directory_summary(quality.file_report(_feats(spark, sf), HOUR))


@query("training_readiness", with_ctes(CLEAN + ", " + FEATS + ", " + STEPS, f"""select symbol, count(*) as rows, {snap_sql('(max(ts) - min(ts)) / 3.6e9::double', 'hours')},
 count(*) filter (where midprice is null or spread is null or bid_px_01 is null or ask_px_01 is null) as rows_with_nulls, count(*) filter (where dt < 0) as steps_back,
 min(midprice) as price_min, max(midprice) as price_max, quantile_cont(dt, 0.5)::double as median_step_us, count(*) >= 70 as enough_rows,
 (max(ts) - min(ts)) / 3.6e9::double >= 6 as enough_hours, min(midprice) > 0 and max(midprice) / min(midprice) <= 100 as price_ok,
 coalesce(abs(quantile_cont(dt, 0.5) - 3600000000) / 3600000000 < 0.1, false) as step_ok from stp group by 1"""))
def training_readiness(spark, sf):
    """Is the table fit for training, with hourly steps expected."""
    return snapped(quality.training_readiness(_feats(spark, sf), step_us=HOUR), "hours")


@query("bar_report", with_ctes(TRADES + f""", b as (select symbol, ts - ts % {HOUR} as bucket, arg_min(price, (ts, seq)) as open, max(price) as high,
 min(price) as low, arg_max(price, (ts, seq)) as close, sum(qty) as volume, sum(price * qty) / nullif(sum(qty), 0) as vwap from trades where price > 0 group by 1, 2)""",
 " union all ".join(f"""select '{c}' as "column", true as present, count(*) - count({c}) as nulls, {snap_sql(f'min({c})', 'min')},
 {snap_sql(f'max({c})', 'max')}, {snap_sql(f'avg({c})', 'mean')} from b""" for c in ("open", "high", "low", "close", "volume", "vwap"))
 + """ union all select 'number_of_trades', false, null::bigint, null::double, null::double, null::double"""))
def bar_report(spark, sf):
    """Presence, nulls and ranges of bar columns; one column is left out."""
    out = quality.bar_report(bars.trade_bars(trades(spark, sf), HOUR).drop("number_of_trades"))
    return snapped(out, "min", "max", "mean")


HOR = "mp as (select *, " + MICRO + """ as mic from book), mr as (
 select unnest([1, 5, 10]) as horizon, unnest([lead(mic, 1) over w / mic - 1, lead(mic, 5) over w / mic - 1, lead(mic, 10) over w / mic - 1]) as r0,
 unnest([(lead(mic, 1) over w - mic) / mic, (lead(mic, 5) over w - mic) / mic, (lead(mic, 10) over w - mic) / mic]) as r
 from mp window w as (partition by symbol order by ts, seq))"""


@query("direction_shares", with_ctes(CLEAN + ", " + HOR, f"""select horizon, count(*) filter (where r > 1e-4::double) as up, count(*) filter (where r < -1e-4::double) as down,
 count(*) filter (where abs(r) <= 1e-4::double) as flat, {snap_sql('avg(r) * 10000', 'mean_bps')}, {snap_sql('stddev_pop(r) * 10000', 'std_bps')} from mr where r is not null group by 1"""))
def direction_shares(spark, sf):
    """Up, down and flat moves per horizon."""
    return snapped(quality.direction_shares(_feats(spark, sf)), "mean_bps", "std_bps")


CORR = ["ofi", "spread", "taker_buy_volume"]


@query("target_correlations", with_ctes(CLEAN + ", " + FEATS + """, nx as (select *, (lead(microprice) over w - microprice) / microprice as r from fb window w as (partition by symbol order by ts, seq))""",
 " union all ".join(f"select '{c}' as feature, {snap_sql(f'corr({c}, r)', 'correlation')} from nx" for c in CORR)))
def target_correlations(spark, sf):
    """Correlation with the next return."""
    return snapped(quality.target_correlations(_feats(spark, sf), CORR), "correlation")


PROFILED = ["midprice", "spread", "ofi", "taker_buy_volume"]


@query("column_profile", with_ctes(CLEAN + ", " + FEATS, " union all ".join(f"""select '{c}' as "column", count(*) - count({c}) as nulls, {snap_sql(f'stddev_samp({c})', 'std', 4)},
 max(abs({c})) as max_abs, stddev_samp({c}) < 1e-10::double as is_constant, max(abs({c})) > 100 as is_extreme from fb""" for c in PROFILED)))
def column_profile(spark, sf):
    """Constant and extreme columns."""
    return snapped(quality.column_profile(_feats(spark, sf), PROFILED), "std", digits=4)


@query("null_counts", with_ctes(SNAPSHOTS, "select * from (" + " union all ".join(
    f"""select '{c}' as "column", count(*) - count({c}) as nulls from snaps""" for s in ("bid", "ask") for w in ("px", "sz") for c in ladder(s, w, 10)) + ") where nulls > 0"))
def null_counts(spark, sf):
    """Columns with nulls."""
    return quality.null_counts(snapshots(spark, sf).drop("symbol", "ts", "seq"))


@query("sortedness", """select symbol, count(*) filter (where v < before) as unsorted, count(*) filter (where v < before) = 0 as is_sorted from (
 select *, lag(v) over (partition by symbol order by seq) as before from (select event_type as symbol, event_id as seq,
  epoch_us(ts) + (event_id % 50) * 3600000000 as v from events)) group by 1""")
def sortedness(spark, sf):
    """Rows below their predecessor in arrival order."""
    t = trades(spark, sf).select("symbol", "seq", (F.col("ts") + (F.col("seq") % 50) * HOUR).alias("v"))
    return quality.unsorted_rows(t, Order(("symbol",), "seq", ()), "v")


@query("dataset_info", with_ctes(CLEAN + ", " + FEATS + ", " + STEPS, f"""select symbol, count(*) as total_rows, min(ts) as start_ts, max(ts) as end_ts,
 {snap_sql('(max(ts) - min(ts)) / 3.6e9::double', 'time_range_hours')}, floor(quantile_cont(dt, 0.5))::bigint as bucket_size_us, 8::bigint as n_available, 41::bigint as n_missing from stp group by 1"""))
def dataset_info(spark, sf):
    """Rows, range, median step, and how many training features are present."""
    out = quality.dataset_info(_feats(spark, sf))
    out = out.withColumns({"n_available": F.size("available_features").cast("bigint"), "n_missing": F.size("missing_features").cast("bigint")})
    return snapped(out.drop("available_features", "missing_features"), "time_range_hours")
