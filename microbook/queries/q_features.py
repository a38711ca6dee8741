"""Queries on microstructure features over book snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from microbook.functions.names import ladder
from microbook.operators import features
from microbook.plans.ordered import DEFAULT, Order, layout, over_rows
from microbook.queries.registry import query, snap_sql, snapped, with_ctes
from microbook.queries.tables import CLEAN, TRADES, clean_rows, trades

ID = ("symbol", "ts", "seq")
W = "window w as (partition by symbol order by ts, seq)"


def _sum(side: str, n: int) -> str:
    return "(" + " + ".join(ladder(side, "sz", n)) + ")"


def roll_sql(kind: str, x: str, n: int) -> str:
    """Rolling aggregate that is null until n non-null rows are there."""
    frame = f"over (partition by symbol order by ts, seq rows between {n - 1} preceding and current row)"
    return f"case when count({x}) {frame} = {n} then {kind}({x}) {frame} end"


MID = "(bid_px_01 + ask_px_01) / 2"


def pick(df, *columns):
    return df.select(*ID, *columns)


@query("feature_basic", with_ctes(CLEAN, f"""select symbol, ts, seq, {MID} as midprice, ask_px_01 - bid_px_01 as spread,
 {snap_sql(f'(ask_px_01 - bid_px_01) / ({MID}) * 10000', 'spread_bps')} from book"""))
def feature_basic(spark, sf):
    return snapped(pick(features.basic(clean_rows(spark, sf)), "midprice", "spread", "spread_bps"), "spread_bps")


@query("feature_imbalance", with_ctes(CLEAN, "select symbol, ts, seq, " + ", ".join(
    f"{_sum('bid', n)} as bid_vol_{n}, {_sum('ask', n)} as ask_vol_{n}, "
    + snap_sql(f"({_sum('bid', n)} - {_sum('ask', n)}) / nullif({_sum('bid', n)} + {_sum('ask', n)}, 0)", f"imbalance_{n}")
    for n in (1, 5, 10)) + f", {snap_sql('(bid_sz_01 - ask_sz_01) / nullif(bid_sz_01 + ask_sz_01, 0)', 'imbalance')} from book"))
def feature_imbalance(spark, sf):
    names = [f"{k}_{n}" for n in (1, 5, 10) for k in ("bid_vol", "ask_vol", "imbalance")] + ["imbalance"]
    out = pick(features.imbalance(clean_rows(spark, sf)), *names)
    return snapped(out, "imbalance_1", "imbalance_5", "imbalance_10", "imbalance")


OFI = """flow1 as (select symbol, ts, seq, bid_sz_01, ask_sz_01,
  bid_sz_01 - lag(bid_sz_01) over w as delta_bid_sz, ask_sz_01 - lag(ask_sz_01) over w as delta_ask_sz,
  bid_px_01 - lag(bid_px_01) over w as delta_bid_px, ask_px_01 - lag(ask_px_01) over w as delta_ask_px
  from book """ + W + """),
flows as (select *, delta_bid_sz - delta_ask_sz as ofi from flow1)"""


@query("feature_ofi", with_ctes(CLEAN + ", " + OFI, f"""select symbol, ts, seq, delta_bid_sz, delta_ask_sz, delta_bid_px, delta_ask_px, ofi,
 ofi + case when delta_bid_px > 0 then bid_sz_01 else 0 end - case when delta_ask_px < 0 then ask_sz_01 else 0 end as ofi_enhanced,
 {roll_sql('sum', 'ofi', 10)} as ofi_10,
 case when ofi is not null then sum(ofi) over (partition by symbol order by ts, seq rows unbounded preceding) end as ofi_cumulative from flows"""))
def feature_ofi(spark, sf):
    """Order-flow imbalance: deltas, price-aware, rolling and cumulative."""
    df = over_rows(clean_rows(spark, sf), lambda d, w: features.order_flow(d, w), back=10)
    return pick(features.ofi_cumulative(df), "delta_bid_sz", "delta_ask_sz", "delta_bid_px", "delta_ask_px", "ofi",
                "ofi_enhanced", "ofi_10", "ofi_cumulative")


MICRO = "(bid_sz_01 * ask_px_01 + ask_sz_01 * bid_px_01) / nullif(bid_sz_01 + ask_sz_01, 0)"


@query("feature_microprice", with_ctes(CLEAN, f"select symbol, ts, seq, {snap_sql(MICRO, 'microprice')} from book"))
def feature_microprice(spark, sf):
    return snapped(pick(features.microprice(clean_rows(spark, sf)), "microprice"), "microprice")


@query("feature_liquidity", with_ctes(CLEAN, "select symbol, ts, seq, " + ", ".join(
    f"{_sum('bid', n)} as liquidity_bid_{n}, {_sum('ask', n)} as liquidity_ask_{n}, {_sum('bid', n)} + {_sum('ask', n)} as liquidity_{n}"
    for n in (1, 5, 10)) + " from book"))
def feature_liquidity(spark, sf):
    names = [f"{k}{n}" for n in (1, 5, 10) for k in ("liquidity_bid_", "liquidity_ask_", "liquidity_")]
    return pick(features.liquidity(clean_rows(spark, sf)), *names)


@query("feature_trade_flow", with_ctes(CLEAN, f"""select symbol, ts, seq, taker_buy_vol as taker_buy_volume, taker_sell_vol as taker_sell_volume,
 taker_buy_vol - taker_sell_vol as signed_volume,
 {snap_sql('case when taker_buy_vol + taker_sell_vol > 0 then (taker_buy_vol - taker_sell_vol) / (taker_buy_vol + taker_sell_vol) else 0 end', 'volume_imbalance')} from book"""))
def feature_trade_flow(spark, sf):
    out = pick(features.trade_flow(clean_rows(spark, sf)), "taker_buy_volume", "taker_sell_volume", "signed_volume", "volume_imbalance")
    return snapped(out, "volume_imbalance")


RETURNS = f"rets as (select *, ln({MID}) - lag(ln({MID})) over w as returns from book {W})"


@query("feature_returns", with_ctes(CLEAN + ", " + RETURNS, f"select symbol, ts, seq, {snap_sql('returns')} from rets"))
def feature_returns(spark, sf):
    df = features.basic(clean_rows(spark, sf))
    return snapped(pick(over_rows(df, features.returns, back=1), "returns"), "returns")


VOLS = "vols as (select *, " + ", ".join(f"{roll_sql('stddev_samp', 'returns', n)} as volatility_{n}" for n in (20, 50, 100)) + " from rets)"


@query("feature_volatility", with_ctes(CLEAN + ", " + RETURNS + ", " + VOLS, "select symbol, ts, seq, " + ", ".join(
    snap_sql(f"volatility_{n}") for n in (20, 50, 100)) + ", " + snap_sql(roll_sql("stddev_samp", "volatility_20", 50), "vol_of_vol") + " from vols"))
def feature_volatility(spark, sf):
    """Rolling volatility and the volatility of volatility."""
    df = features.basic(clean_rows(spark, sf))
    df = over_rows(df, lambda d, w: features.volatility(features.returns(d, w), w), back=100)
    names = ["volatility_20", "volatility_50", "volatility_100", "vol_of_vol"]
    return snapped(pick(df, *names), *names)


KYLE = f"""k1 as (select *, {MID} - lag({MID}) over w as dp, taker_buy_vol - taker_sell_vol as dv from book {W}),
k2 as (select *, dp - {roll_sql('avg', 'dp', 100)} as pd, dv - {roll_sql('avg', 'dv', 100)} as vd from k1),
k3 as (select *, {roll_sql('avg', '(pd * vd)', 100)} as cov, {roll_sql('avg', '(vd * vd)', 100)} as var from k2)"""


@query("feature_kyle_lambda", with_ctes(CLEAN + ", " + KYLE, f"""select symbol, ts, seq, dp as price_change,
 {snap_sql('case when var > 0 then cov / var else 0 end', 'kyle_lambda')} from k3"""))
def feature_kyle_lambda(spark, sf):
    """Price impact over 100 rows, in two window stages."""
    df = features.basic(clean_rows(spark, sf))
    df = over_rows(df, lambda d, w: features.kyle_lambda(d, w), back=199)
    return snapped(pick(df, "price_change", "kyle_lambda"), "kyle_lambda")


VPIN = f"v1 as (select *, {roll_sql('sum', 'taker_buy_vol', 50)} as b, {roll_sql('sum', 'taker_sell_vol', 50)} as s from book)"


@query("feature_vpin", with_ctes(CLEAN + ", " + VPIN, f"""select symbol, ts, seq,
 {snap_sql('case when b + s > 0 then abs(b - s) / (b + s) else 0 end', 'vpin')} from v1"""))
def feature_vpin(spark, sf):
    df = over_rows(clean_rows(spark, sf), lambda d, w: features.vpin(d, w), back=49)
    return snapped(pick(df, "vpin"), "vpin")


RATIO = {s: f"{s}_sz_01 / ({s}_sz_05 + 1e-10::double)" for s in ("bid", "ask")}


@query("feature_ladder_slope", with_ctes(CLEAN, "select symbol, ts, seq, " + ", ".join(
    f"{snap_sql(RATIO[s], s + '_slope_ratio')}, {snap_sql(f'ln({RATIO[s]})', s + '_ladder_slope')}" for s in ("bid", "ask")) + " from book"))
def feature_ladder_slope(spark, sf):
    names = ["bid_slope_ratio", "ask_slope_ratio", "bid_ladder_slope", "ask_ladder_slope"]
    return snapped(pick(features.ladder_slope(clean_rows(spark, sf)), *names), *names)


@query("feature_queue_imbalance", with_ctes(CLEAN, "select symbol, ts, seq, " + ", ".join(
    snap_sql(f"(bid_sz_0{i} - ask_sz_0{i}) / (bid_sz_0{i} + ask_sz_0{i} + 1e-10::double)", f"queue_imb_{i}") for i in range(1, 6)) + " from book"))
def feature_queue_imbalance(spark, sf):
    names = [f"queue_imb_{i}" for i in range(1, 6)]
    return snapped(pick(features.queue_imbalance(clean_rows(spark, sf)), *names), *names)


ALL = f""", f1 as (select *, {MID} as midprice, {MID} - lag({MID}) over w as dp, ln({MID}) - lag(ln({MID})) over w as returns,
  taker_buy_vol - taker_sell_vol as dv, bid_sz_01 - lag(bid_sz_01) over w - (ask_sz_01 - lag(ask_sz_01) over w) as ofi from book {W}),
f2 as (select *, {roll_sql('stddev_samp', 'returns', 20)} as volatility_20, {roll_sql('stddev_samp', 'returns', 100)} as volatility_100,
  dp - {roll_sql('avg', 'dp', 100)} as pd, dv - {roll_sql('avg', 'dv', 100)} as vd, {roll_sql('sum', 'ofi', 10)} as ofi_10,
  {roll_sql('sum', 'taker_buy_vol', 50)} as b, {roll_sql('sum', 'taker_sell_vol', 50)} as s,
  case when ofi is not null then sum(ofi) over (partition by symbol order by ts, seq rows unbounded preceding) end as ofi_cumulative from f1),
f3 as (select *, {roll_sql('avg', '(pd * vd)', 100)} as cov, {roll_sql('avg', '(vd * vd)', 100)} as var,
  {roll_sql('stddev_samp', 'volatility_20', 50)} as vov from f2)"""
ALL_SELECT = f"""select symbol, ts, seq, midprice, ask_px_01 - bid_px_01 as spread, {snap_sql(MICRO, 'microprice')},
 {snap_sql(f"({_sum('bid', 5)} - {_sum('ask', 5)}) / nullif({_sum('bid', 5)} + {_sum('ask', 5)}, 0)", 'imbalance_5')},
 ofi, ofi_10, ofi_cumulative, {snap_sql('returns')}, {snap_sql('volatility_20')}, {snap_sql('volatility_100')}, {snap_sql('vov', 'vol_of_vol')},
 {snap_sql('case when var > 0 then cov / var else 0 end', 'kyle_lambda')}, {snap_sql('case when b + s > 0 then abs(b - s) / (b + s) else 0 end', 'vpin')},
 {snap_sql(f"ln({RATIO['bid']})", 'bid_ladder_slope')}, '2.0.0' as _schema_version from f3"""
ALL_NAMES = ["midprice", "spread", "microprice", "imbalance_5", "ofi", "ofi_10", "ofi_cumulative", "returns", "volatility_20",
             "volatility_100", "vol_of_vol", "kyle_lambda", "vpin", "bid_ladder_slope", "_schema_version"]
ALL_SNAP = ["microprice", "imbalance_5", "returns", "volatility_20", "volatility_100", "vol_of_vol", "kyle_lambda", "vpin", "bid_ladder_slope"]


@query("features_v2", with_ctes(CLEAN + ALL, ALL_SELECT))
def features_v2(spark, sf):
    """The whole feature pipeline, version 2."""
    return snapped(pick(features.all_features(clean_rows(spark, sf)), *ALL_NAMES), *ALL_SNAP)


@query("features_v2_blocks", with_ctes(CLEAN + ALL, ALL_SELECT))
def features_v2_blocks(spark, sf):
    """The same pipeline with symbols cut into blocks of 256 rows: overlap and prefix sums at work."""
    order = DEFAULT.blocks(256)
    return snapped(pick(features.all_features(clean_rows(spark, sf), order), *ALL_NAMES), *ALL_SNAP)


V1_NAMES = ["midprice", "imbalance_5", "ofi", "ofi_10", "ofi_cumulative", "returns", "volatility_20", "volatility_100"]


@query("features_v1", with_ctes(CLEAN + ALL, f"""select symbol, ts, seq, midprice,
 {snap_sql(f"({_sum('bid', 5)} - {_sum('ask', 5)}) / nullif({_sum('bid', 5)} + {_sum('ask', 5)}, 0)", 'imbalance_5')},
 ofi, ofi_10, ofi_cumulative, {snap_sql('returns')}, {snap_sql('volatility_20')}, {snap_sql('volatility_100')} from f3"""))
def features_v1(spark, sf):
    """The first version of the pipeline."""
    out = features.all_features(clean_rows(spark, sf), version=1)
    return snapped(pick(out, *V1_NAMES), "imbalance_5", "returns", "volatility_20", "volatility_100")


DATED = "day as (select *, ts // 86400000000 as d from book)"


@query("features_reset_daily", with_ctes(CLEAN + ", " + DATED, """select symbol, ts, seq, ofi,
 case when ofi is not null then sum(ofi) over (partition by symbol, d order by ts, seq rows unbounded preceding) end as ofi_cumulative
 from (select *, bid_sz_01 - lag(bid_sz_01) over w - (ask_sz_01 - lag(ask_sz_01) over w) as ofi from day
 window w as (partition by symbol, d order by ts, seq))"""))
def features_reset_daily(spark, sf):
    """Windows that restart at a file border, here the day."""
    df = clean_rows(spark, sf).withColumn("d", F.floor(F.col("ts") / 86_400_000_000).cast("bigint"))
    order = DEFAULT.by("symbol", "d")
    df = over_rows(df, lambda d, w: features.order_flow(d, w), order, back=10)
    return pick(features.ofi_cumulative(df, order), "ofi", "ofi_cumulative")


LAGS = (1, 2, 5, 10, 20)


@query("feature_lags", with_ctes(TRADES, "select symbol, ts, seq, " + ", ".join(
    f"lag({c}, {k}) over w as {c}_lag_{k}" for c in ("price", "qty") for k in LAGS) + f" from trades {W}"))
def feature_lags(spark, sf):
    out = features.lag_features(trades(spark, sf), ["price", "qty", "absent"])
    return out.drop("price", "qty", "buyer_is_maker")


KINDS = {"mean": "avg", "std": "stddev_samp", "sum": "sum", "min": "min", "max": "max"}


@query("feature_rolling", with_ctes(TRADES, "select symbol, ts, seq, " + ", ".join(
    snap_sql(roll_sql(f, "price", n), f"price_{k}_{n}") for k, f in KINDS.items() for n in (10, 30, 60, 120)) + " from trades"))
def feature_rolling(spark, sf):
    out = features.rolling_features(trades(spark, sf), ["price"], kinds=tuple(KINDS))
    names = [f"price_{k}_{n}" for k in KINDS for n in (10, 30, 60, 120)]
    return snapped(pick(out, *names), *names)


HOLES = "holes as (select symbol, ts, seq, case when seq % 3 = 0 then price end as x from trades)"


@query("fill_forward_backward", with_ctes(TRADES + ", " + HOLES, """select symbol, ts, seq,
 last_value(x ignore nulls) over (partition by symbol order by ts, seq rows between unbounded preceding and current row) as fwd,
 first_value(x ignore nulls) over (partition by symbol order by ts, seq rows between current row and unbounded following) as bwd from holes"""))
def fill_forward_backward(spark, sf):
    """Nulls filled from before and from after."""
    df = trades(spark, sf).select(*ID, F.when(F.col("seq") % 3 == 0, F.col("price")).alias("fwd"))
    df = df.withColumn("bwd", F.col("fwd"))
    plan = layout(df)
    return features.backward_fill(features.forward_fill(df, ["fwd"], plan=plan), ["bwd"], plan=plan)


@query("fill_blocks", with_ctes(TRADES + ", " + HOLES, """select symbol, ts, seq,
 last_value(x ignore nulls) over (partition by symbol order by ts, seq rows between unbounded preceding and current row) as fwd,
 first_value(x ignore nulls) over (partition by symbol order by ts, seq rows between current row and unbounded following) as bwd from holes"""))
def fill_blocks(spark, sf):
    """The same fills with symbols cut into blocks of 64 rows."""
    order = Order(block_rows=64)
    df = trades(spark, sf).select(*ID, F.when(F.col("seq") % 3 == 0, F.col("price")).alias("fwd"))
    df = df.withColumn("bwd", F.col("fwd"))
    plan = layout(df, order)
    return features.backward_fill(features.forward_fill(df, ["fwd"], order, plan), ["bwd"], order, plan)
