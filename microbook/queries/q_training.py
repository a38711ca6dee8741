"""Queries on scaling, targets, sequences and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from microbook.functions.names import TRAINING_FEATURES, classify
from microbook.operators import dataset, features, normalize, splits
from microbook.plans.ordered import DEFAULT
from microbook.queries.q_features import ALL, MICRO, MID
from microbook.queries.registry import query, snap_sql, snapped, with_ctes
from microbook.queries.tables import CLEAN, HOUR, LINES, LINES_SQL, TRADES, clean_rows, lines, stored, trades

STANDARD = ["spread", "ofi", "imbalance", "signed_volume"]
ROBUST = ["bid_sz_01", "ask_sz_01", "taker_buy_volume", "taker_sell_volume"]
TRAIN = """tr as (select symbol, ts, seq, ask_px_01 - bid_px_01 as spread, bid_sz_01 - lag(bid_sz_01) over w - (ask_sz_01 - lag(ask_sz_01) over w) as ofi,
  (bid_sz_01 - ask_sz_01) / (bid_sz_01 + ask_sz_01) as imbalance, taker_buy_vol - taker_sell_vol as signed_volume, bid_sz_01, ask_sz_01,
  taker_buy_vol as taker_buy_volume, taker_sell_vol as taker_sell_volume, (bid_px_01 + ask_px_01) / 2 as midprice
  from book window w as (partition by symbol order by ts, seq))"""


def training_table(spark, sf):
    """Feature rows: four standard, four robust and two unscaled columns."""
    def build():
        df = features.all_features(clean_rows(spark, sf))
        return df.select("symbol", "ts", "seq", *STANDARD, *ROBUST, "midprice", "microprice", "imbalance_5", "ofi_10", "bid_px_01", "volatility_20")

    return stored(spark, sf, "features", build)


def scaling_table(spark, sf):
    return training_table(spark, sf).select("symbol", "ts", "seq", *STANDARD, *ROBUST, "midprice")


@query("scaling_classes", with_ctes(CLEAN + ", " + TRAIN, """select scaler, string_agg(name, ',' order by name) as members, (select count(*) from tr) as n_rows from (
 select unnest(['spread', 'ofi', 'imbalance', 'signed_volume']) as name, 'standard' as scaler union all
 select unnest(['bid_sz_01', 'ask_sz_01', 'taker_buy_volume', 'taker_sell_volume']), 'robust' union all
 select unnest(['ts', 'midprice']), 'passthrough' union all select unnest(['symbol', 'seq']), 'unknown') group by 1"""))
def scaling_classes(spark, sf):
    """Columns of the feature table by scaling method."""
    df = scaling_table(spark, sf)
    groups = {k: sorted(v) for k, v in classify(df.columns).items() if v}
    shape = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return shape.select("n_rows", F.inline(F.array(*[
        F.struct(F.lit(k).alias("scaler"), F.lit(",".join(v)).alias("members")) for k, v in groups.items()
    ])))


FIT_STD = " union all ".join(
    f"select '{c}' as feature, 'standard' as scaler, {snap_sql(f'avg({c})', 'mean')}, {snap_sql(f'stddev_samp({c})', 'std')}, "
    f"count({c}) as n_samples, count(*) - count({c}) as n_nulls from tr" for c in STANDARD)


@query("scaler_fit_standard", with_ctes(CLEAN + ", " + TRAIN, FIT_STD))
def scaler_fit_standard(spark, sf):
    out = normalize.fit_standard(scaling_table(spark, sf), STANDARD)
    return snapped(out.select("feature", "scaler", "mean", "std", "n_samples", "n_nulls"), "mean", "std")


def _robust_sql(q: str) -> str:
    return " union all ".join(
        f"select '{c}' as feature, {snap_sql(f'{q}(ln(1 + {c}), 0.25)', 'q25')}, {snap_sql(f'quantile_cont(ln(1 + {c}), 0.5)', 'median')}, "
        f"{snap_sql(f'{q}(ln(1 + {c}), 0.75)', 'q75')}, {snap_sql(f'{q}(ln(1 + {c}), 0.75) - {q}(ln(1 + {c}), 0.25)', 'iqr')}, count({c}) as n_samples from tr"
        for c in ROBUST)


@query("scaler_fit_robust", with_ctes(CLEAN + ", " + TRAIN, _robust_sql("quantile_cont")))
def scaler_fit_robust(spark, sf):
    """Quartiles of log1p, linear between ranks."""
    out = normalize.fit_robust(scaling_table(spark, sf), ROBUST, interpolation="linear")
    names = ["q25", "median", "q75", "iqr"]
    return snapped(out.select("feature", *names, "n_samples"), *names)


NEAREST = " union all ".join(
    f"""select '{c}' as feature, {snap_sql("max(case when rn - 1 = floor(0.25 * (n - 1) + 0.5) then x end)", 'q25')},
 {snap_sql("max(case when rn - 1 = floor(0.75 * (n - 1) + 0.5) then x end)", 'q75')} from (select ln(1 + {c}) as x, row_number() over (order by {c}) as rn, count(*) over () as n from tr)"""
    for c in ROBUST)


@query("scaler_fit_nearest", with_ctes(CLEAN + ", " + TRAIN, NEAREST))
def scaler_fit_nearest(spark, sf):
    """Quartiles at the nearest rank."""
    return snapped(normalize.fit_robust(scaling_table(spark, sf), ROBUST).select("feature", "q25", "q75"), "q25", "q75")


@query("scaler_fit_minmax", with_ctes(LINES_SQL, " union all ".join(
    f"select '{c}' as feature, min({c}) as min_val, max({c}) as max_val, count(*) as n_samples from lines" for c in ("price", "qty", "discount", "tax"))))
def scaler_fit_minmax(spark, sf):
    out = normalize.fit_minmax(lines(spark, sf), ["price", "qty", "discount", "tax"])
    return out.select("feature", "min_val", "max_val", "n_samples")


def _scale_sql(c: str) -> str:
    if c in STANDARD:
        return snap_sql(f"({c} - m_{c}) / s_{c}", c, 4)
    return snap_sql(f"(ln(1 + {c}) - m_{c}) / s_{c}", c, 4)


STATS = "st as (select " + ", ".join(
    [f"avg({c}) as m_{c}, stddev_samp({c}) as s_{c}" for c in STANDARD]
    + [f"quantile_cont(ln(1 + {c}), 0.5) as m_{c}, quantile_cont(ln(1 + {c}), 0.75) - quantile_cont(ln(1 + {c}), 0.25) as s_{c}" for c in ROBUST]) + " from tr)"


@query("scaler_transform", with_ctes(CLEAN + ", " + TRAIN + ", " + STATS, "select symbol, ts, seq, " + ", ".join(
    _scale_sql(c) for c in STANDARD + ROBUST) + ", midprice from tr, st"))
def scaler_transform(spark, sf):
    """Fit every class in one go, scale in one projection."""
    df = scaling_table(spark, sf)
    out = normalize.transform(df, normalize.fit(df, interpolation="linear"))
    return snapped(out, *STANDARD, *ROBUST, digits=4)


@query("scaler_fit_then_apply", with_ctes(CLEAN + ", " + TRAIN + """,
 cut as (select *, ts < 1704672000000000 as train from tr), st as (select avg(spread) as m, stddev_samp(spread) as s from cut where train)""",
 f"select symbol, ts, seq, train, {snap_sql('(spread - m) / s', 'spread', 4)} from cut, st"))
def scaler_fit_then_apply(spark, sf):
    """Fit on the first week, apply to it and to the rest."""
    df = scaling_table(spark, sf).select("symbol", "ts", "seq", "spread").withColumn("train", F.col("ts") < 1_704_672_000_000_000)
    first, rest = df.filter("train"), df.filter(~F.col("train"))
    _, (a, b) = normalize.fit_first_then_transform(first, rest)
    return snapped(a.unionByName(b), "spread", digits=4)


LINE_FEATURES = ["price", "qty", "discount", "tax"]


@query("scaler_transform_lineitem", with_ctes(LINES_SQL + ", st as (select " + ", ".join(
    f"avg({c}) as m_{c}, stddev_samp({c}) as s_{c}" for c in LINE_FEATURES) + " from lines)",
    "select l_orderkey, l_linenumber, l_partkey, l_suppkey, " + ", ".join(snap_sql(f"({c} - m_{c}) / s_{c}", c, 4) for c in LINE_FEATURES) + " from lines, st"))
def scaler_transform_lineitem(spark, sf):
    """Standard scaling of the large table."""
    df = lines(spark, sf).drop("symbol", "ts")
    return snapped(normalize.transform(df, normalize.fit_standard(df, LINE_FEATURES)), *LINE_FEATURES, digits=4)


@query("scaler_check", with_ctes(CLEAN + ", " + TRAIN, " union all ".join(
    f"""select '{c}' as feature, 'standard' as scaler, abs(avg(z)) <= 0.1 as valid, abs(avg(z)) > 0.1 or abs(stddev_samp(z) - 1) > 0.2 as warning
 from (select ({c} - (select avg({c}) from tr)) / (select stddev_samp({c}) from tr) as z from tr)""" for c in STANDARD)))
def scaler_check(spark, sf):
    """Scaled columns have mean 0 and deviation 1."""
    df = scaling_table(spark, sf).select("symbol", "ts", "seq", *STANDARD)
    manifest = normalize.fit_standard(df, STANDARD)
    return normalize.check_scaled(normalize.transform(df, manifest), manifest).select("feature", "scaler", "valid", "warning")


@query("scaler_inverse", with_ctes(CLEAN + ", " + TRAIN, f"select symbol, ts, seq, {snap_sql('spread')}, {snap_sql('imbalance')} from tr"))
def scaler_inverse(spark, sf):
    """Scale and undo."""
    df = scaling_table(spark, sf).select("symbol", "ts", "seq", "spread", "imbalance")
    manifest = normalize.fit_standard(df, ["spread", "imbalance"])
    out = normalize.inverse_standard(normalize.transform(df, manifest), manifest, ["spread", "imbalance"])
    return snapped(out, "spread", "imbalance")


@query("preprocess_zscore", with_ctes(CLEAN + ", " + TRAIN + """,
 st as (select avg(ofi) as m, stddev_samp(ofi) as s, avg(spread) as m2, stddev_samp(spread) as s2 from tr),
 fl as (select *, coalesce(last_value(ofi ignore nulls) over (partition by symbol order by ts, seq rows between unbounded preceding and current row),
   first_value(ofi ignore nulls) over (partition by symbol order by ts, seq rows between current row and unbounded following), 0) as o from tr)""",
 f"""select symbol, ts, seq, {snap_sql('(least(greatest(o, m - 2 * s), m + 2 * s) - m) / s', 'ofi', 4)},
 {snap_sql('(least(greatest(spread, m2 - 2 * s2), m2 + 2 * s2) - m2) / s2', 'spread', 4)} from fl, st"""))
def preprocess_zscore(spark, sf):
    """Fill, replace infinities, clip at two deviations, standardise."""
    df = scaling_table(spark, sf).select("symbol", "ts", "seq", "ofi", "spread")
    stats = normalize.fit_stats(df, ["ofi", "spread"])
    return snapped(normalize.preprocess(df, stats, ["ofi", "spread"], clip_std=2.0), "ofi", "spread", digits=4)


@query("preprocess_minmax", with_ctes(CLEAN + ", " + TRAIN + ", st as (select min(ofi) as lo, max(ofi) as hi from tr)",
                                      f"select symbol, ts, seq, {snap_sql('(coalesce(ofi, 0) - lo) / (hi - lo)', 'ofi')} from tr, st"))
def preprocess_minmax(spark, sf):
    """Nulls to zero, scaled to [0, 1]."""
    df = scaling_table(spark, sf).select("symbol", "ts", "seq", "ofi")
    stats = normalize.fit_stats(df, ["ofi"])
    return snapped(normalize.preprocess(df, stats, ["ofi"], "minmax", None, "zero"), "ofi")


@query("preprocess_drop", with_ctes(CLEAN + ", " + TRAIN, "select symbol, ts, seq, ofi, spread from tr where ofi is not null"))
def preprocess_drop(spark, sf):
    """Rows with nulls dropped, no scaling."""
    df = scaling_table(spark, sf).select("symbol", "ts", "seq", "ofi", "spread")
    return normalize.preprocess(df, normalize.fit_stats(df, ["ofi"]), ["ofi"], None, None, "drop")


@query("infinite_to_constant", with_ctes(TRADES, "select seq, case when seq % 10 = 0 then 0.0::double else price end as price from trades"))
def infinite_to_constant(spark, sf):
    """Infinities become zero."""
    inf = F.when(F.col("seq") % 20 == 0, float("inf")).when(F.col("seq") % 10 == 0, float("-inf")).otherwise(F.col("price"))
    return normalize.replace_infinite(trades(spark, sf).select("seq", inf.alias("price")), ["price"])


# --- targets and sequences --------------------------------------------------------------------

@query("target_return", with_ctes(CLEAN, f"""select symbol, ts, seq, {snap_sql(f'(lead({MID}, 10) over w - {MID}) / ({MID}) * 10000', 'target')}
 from book window w as (partition by symbol order by ts, seq)"""))
def target_return(spark, sf):
    """Return over ten rows, in basis points."""
    df = features.basic(clean_rows(spark, sf)).select("symbol", "ts", "seq", "midprice")
    return snapped(dataset.create_target(df).drop("midprice"), "target")


@query("target_price_delta", with_ctes(TRADES, "select symbol, ts, seq, lead(price, 5) over (partition by symbol order by ts, seq) - price as target from trades"))
def target_price_delta(spark, sf):
    df = trades(spark, sf).withColumnRenamed("price", "bid_px_01")
    return dataset.create_target(df, "price_delta", 5).select("symbol", "ts", "seq", "target")


@query("target_direction", with_ctes(CLEAN, f"""select symbol, ts, seq, case when r > 0.5 then 1 when r is not null then 0 end as target from (
 select *, (lead({MID}, 10) over w - {MID}) / ({MID}) * 10000 as r from book window w as (partition by symbol order by ts, seq))"""))
def target_direction(spark, sf):
    df = features.basic(clean_rows(spark, sf)).select("symbol", "ts", "seq", "midprice")
    return dataset.create_target(df, "direction").drop("midprice").withColumn("target", F.col("target").cast("int"))


SEG = """sg as (select *, sum(case when ts - before > 7200000000 then 1 else 0 end) over (partition by symbol order by ts, seq rows unbounded preceding) as segment_id
 from (select *, lag(ts) over (partition by symbol order by ts, seq) as before from book))"""


@query("target_leak_safe", with_ctes(CLEAN + ", " + SEG, f"""select symbol, ts, seq, lead({MID}, 3) over (partition by symbol, segment_id order by ts, seq) - {MID} as target from sg"""))
def target_leak_safe(spark, sf):
    """Targets that do not look across a gap."""
    df = splits.with_segments(features.basic(clean_rows(spark, sf)), HOUR)
    return dataset.create_target(df, "price_delta", 3, segment="segment_id").select("symbol", "ts", "seq", "target")


@query("feature_selection", with_ctes(CLEAN + ", " + TRAIN, f"""select symbol, ts, {MID} as midprice, ask_px_01 - bid_px_01 as spread, {snap_sql(MICRO, 'microprice')} from book"""))
def feature_selection(spark, sf):
    """Wanted features that exist, in their order."""
    df = training_table(spark, sf)
    return snapped(dataset.select_features(df, ["midprice", "spread", "microprice", "absent"]), "microprice")


@query("feature_output_columns", with_ctes(CLEAN, "select symbol, ts, bid_px_01, bid_sz_01, ask_sz_01, " + MID + " as midprice, ask_px_01 - bid_px_01 as spread, "
       + snap_sql("(bid_sz_01 - ask_sz_01) / nullif(bid_sz_01 + ask_sz_01, 0)", "imbalance") + ", taker_buy_vol as taker_buy_volume, taker_sell_vol as taker_sell_volume, taker_buy_vol - taker_sell_vol as signed_volume from book"))
def feature_output_columns(spark, sf):
    """Output columns in order, those present only."""
    df = training_table(spark, sf).drop("microprice", "imbalance_5", "ofi", "ofi_10", "volatility_20", "seq")
    return snapped(dataset.output_columns(df), "imbalance")


@query("drop_and_fill_nulls", with_ctes(CLEAN + ", " + TRAIN, "select symbol, ts, seq, coalesce(ofi, -1) as ofi from tr where seq % 5 <> 0 or ofi is not null"))
def drop_and_fill_nulls(spark, sf):
    """Rows without a needed value dropped, other nulls set to a constant."""
    df = scaling_table(spark, sf).select("symbol", "ts", "seq", "ofi")
    needed = F.when(F.col("seq") % 5 == 0, F.col("ofi")).otherwise(0.0)
    return df.withColumn("_n", needed).dropna(subset=["_n"]).drop("_n").fillna(-1.0, ["ofi"])


@query("sequences_forecast", with_ctes(TRADES, """select symbol, ts as start_ts, lead(ts, 29) over w as end_ts, 20 as n_x, 10 as n_y, price as first_x,
 lead(price, 19) over w as last_x, lead(price, 20) over w as first_y, lead(price, 29) over w as last_y
 from (select *, row_number() over (partition by symbol order by ts, seq) as rn, count(*) over (partition by symbol) as n from trades)
 window w as (partition by symbol order by ts, seq) qualify (rn - 1) % 7 = 0 and rn + 29 <= n"""))
def sequences_forecast(spark, sf):
    """Twenty inputs, ten outputs, a start every seven rows; shapes and end points."""
    s = dataset.forecast_sequences(trades(spark, sf), ["price", "qty"], ["price"], 20, 10, 7)
    return s.select(
        "symbol", "start_ts", "end_ts", F.size("x").alias("n_x"), F.size("y").alias("n_y"), F.col("x")[0][0].alias("first_x"),
        F.col("x")[19][0].alias("last_x"), F.col("y")[0][0].alias("first_y"), F.col("y")[9][0].alias("last_y"),
    )


@query("sequences_labelled", with_ctes(TRADES, """select symbol, ts, 50 as n_x, lag(price, 49) over w as first_x, price as last_x, qty as y
 from (select *, row_number() over (partition by symbol order by ts, seq) as rn from trades) window w as (partition by symbol order by ts, seq)
 qualify rn >= 50 and (rn - 50) % 5 = 0"""))
def sequences_labelled(spark, sf):
    """Fifty rows labelled by the last one, every fifth row."""
    s = dataset.labelled_sequences(trades(spark, sf), ["price"], "qty", 50, 5)
    return s.select("symbol", "ts", F.size("x").alias("n_x"), F.col("x")[0][0].alias("first_x"), F.col("x")[49][0].alias("last_x"), "y")


# --- segments and splits ----------------------------------------------------------------------

@query("split_gaps", with_ctes(CLEAN, """select symbol, count(*) as n_gaps, min(d) as min_gap_us, max(d) as max_gap_us, quantile_cont(d, 0.5)::double as median_gap_us
 from (select symbol, ts - lag(ts) over (partition by symbol order by ts, seq) as d from book) where d > 7200000000 group by 1"""))
def split_gaps(spark, sf):
    """Number and size of gaps over two hours."""
    return splits.gap_stats(clean_rows(spark, sf), HOUR)


@query("split_segments", with_ctes(CLEAN + ", " + SEG, f"""select symbol, segment_id, min(ts) as start_ts, max(ts) as end_ts, count(*) as n_rows,
 {snap_sql('(max(ts) - min(ts)) / 3.6e9::double', 'duration_hours')} from sg group by 1, 2 having count(*) >= 3"""))
def split_segments(spark, sf):
    """Gap-free segments of at least three rows."""
    s = splits.segments(splits.with_segments(clean_rows(spark, sf).select("symbol", "ts", "seq"), HOUR), 3)
    return snapped(s.withColumn("segment_id", F.col("segment_id").cast("bigint")), "duration_hours")


CUT = """ct as (select *, row_number() over (partition by symbol, segment_id order by ts, seq) as rn, count(*) over (partition by symbol, segment_id) as n from sg),
cs as (select *, case when rn <= floor(n * 0.8::double) then 'train' else 'test' end as split from ct where n >= 10 and n - floor(n * 0.8::double) >= 2)"""


def _cut(spark, sf):
    return splits.segment_split(splits.with_segments(clean_rows(spark, sf).select("symbol", "ts", "seq"), HOUR), 0.8, 10, 2)


@query("split_by_segment", with_ctes(CLEAN + ", " + SEG + ", " + CUT, "select symbol, ts, seq, segment_id::bigint as segment_id, split from cs"))
def split_by_segment(spark, sf):
    """Each segment cut 80/20."""
    return _cut(spark, sf).select("symbol", "ts", "seq", F.col("segment_id").cast("bigint").alias("segment_id"), "split")


@query("split_train_rows", with_ctes(CLEAN + ", " + SEG + ", " + CUT, "select symbol, ts, seq from cs where split = 'train'"))
def split_train_rows(spark, sf):
    return splits.train_test(_cut(spark, sf))[0].select("symbol", "ts", "seq")


@query("split_test_rows", with_ctes(CLEAN + ", " + SEG + ", " + CUT, "select symbol, ts, seq from cs where split = 'test'"))
def split_test_rows(spark, sf):
    return splits.train_test(_cut(spark, sf))[1].select("symbol", "ts", "seq")


@query("split_summary", with_ctes(CLEAN + ", " + SEG + ", " + CUT, """select symbol, count(distinct segment_id) as n_segments,
 count(*) filter (where split = 'train') as total_train_rows, count(*) filter (where split = 'test') as total_test_rows from cs group by 1"""))
def split_summary(spark, sf):
    return splits.split_summary(_cut(spark, sf), "symbol")


NUM = "nb as (select *, row_number() over (partition by symbol order by ts, seq) as rn, count(*) over (partition by symbol) as n from trades)"


@query("split_walk_forward", with_ctes(TRADES + ", " + NUM + """,
 b as (select nb.*, f.fold, n - floor(n * 0.1::double)::bigint * (5 - f.fold - 1) as e, floor(n * 0.1::double)::bigint as t from nb, (select unnest(range(5)) as fold) f)""",
 """select symbol, fold::int as fold, split, count(*) as n_rows, min(ts) as first_ts, max(ts) as last_ts from (
 select *, case when rn <= e - t - 3 then 'train' when rn > e - t and rn <= e then 'test' end as split from b) where split is not null group by 1, 2, 3"""))
def split_walk_forward(spark, sf):
    """Five expanding splits with three rows left out before each test."""
    out = splits.walk_forward(trades(spark, sf), 5, 0.1, 3)
    return out.groupBy("symbol", "fold", "split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )


@query("split_time_series_folds", with_ctes(TRADES + ", " + NUM + """,
 b as (select nb.*, f.fold, n - (n // 6) * (5 - f.fold - 1) as e, n // 6 as t from nb, (select unnest(range(5)) as fold) f)""",
 """select symbol, seq, fold::int as fold, split from (select *, case when rn <= e - t then 'train' when rn > e - t and rn <= e then 'test' end as split from b) where split is not null"""))
def split_time_series_folds(spark, sf):
    """Expanding folds for a search, row by row."""
    return splits.time_series_folds(trades(spark, sf)).select("symbol", "seq", "fold", "split")


@query("split_rolling_window", with_ctes(TRADES + ", " + NUM + """,
 b as (select nb.*, f.fold, n - (n // 6) * (5 - f.fold - 1) as e, n // 6 as t from nb, (select unnest(range(5)) as fold) f)""",
 """select symbol, fold::int as fold, split, count(*) as n_rows from (select *, case when rn > greatest(e - t - 100, 0) and rn <= e - t then 'train'
 when rn > e - t and rn <= e then 'test' end as split from b) where split is not null group by 1, 2, 3"""))
def split_rolling_window(spark, sf):
    """Training windows of 100 rows."""
    out = splits.walk_forward_blocks(trades(spark, sf), 5, train_window=100)
    return out.groupBy("symbol", "fold", "split").agg(F.count(F.lit(1)).alias("n_rows"))


@query("split_chronological", with_ctes(TRADES + ", " + NUM, """select symbol, seq, case when rn <= floor(n * 0.7::double) then 'train'
 when rn <= floor(n * (0.7::double + 0.15::double)) then 'val' else 'test' end as split from nb"""))
def split_chronological(spark, sf):
    """70/15/15 by position."""
    return splits.chronological(trades(spark, sf)).select("symbol", "seq", "split")


@query("split_tail_validation", with_ctes(TRADES + ", " + NUM, "select symbol, seq, rn > n - floor(n * 0.15::double) as is_validation from nb"))
def split_tail_validation(spark, sf):
    """The last 15 % for validation."""
    return splits.tail_validation(trades(spark, sf)).select("symbol", "seq", "is_validation")


@query("split_chronological_lineitem", with_ctes(LINES_SQL + """, nb as (select *, row_number() over (partition by symbol order by ts, l_orderkey, l_linenumber, l_partkey, l_suppkey) as rn,
 count(*) over (partition by symbol) as n from lines)""", """select symbol, split, count(*) as n_rows, min(ts) as first_ts, max(ts) as last_ts from (select *, case when rn <= floor(n * 0.7::double) then 'train'
 when rn <= floor(n * (0.7::double + 0.15::double)) then 'val' else 'test' end as split from nb) group by 1, 2"""))
def split_chronological_lineitem(spark, sf):
    """Six heavy keys with many equal times, cut into blocks of 4,096 rows."""
    out = splits.chronological(lines(spark, sf), order=LINES.blocks(4096))
    return out.groupBy("symbol", "split").agg(F.count(F.lit(1)).alias("n_rows"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
