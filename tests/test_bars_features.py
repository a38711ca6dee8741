"""Known values of bars, buckets and features, and pandas as a second opinion."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from microbook.operators import bars, features
from microbook.plans.ordered import DEFAULT

BASE = 1_705_320_000_000_000
MINUTE = 60_000_000


@pytest.fixture(scope="module")
def trades(spark):
    at = [0, 10, 30, 50, 60, 70, 90, 110]
    px = [100, 101, 99, 100.5, 100.5, 102, 98, 101]
    qty = [1, 2, 1.5, 0.5, 1, 3, 2, 1]
    rows = [("A", BASE + s * 1_000_000, i, float(p), float(q)) for i, (s, p, q) in enumerate(zip(at, px, qty))]
    return spark.createDataFrame(rows, "symbol string, ts bigint, seq bigint, last_trade_px double, last_trade_qty double")


def test_trade_bars(trades):
    a, b = bars.trade_bars(trades, MINUTE, "last_trade_px", "last_trade_qty").orderBy("bucket").collect()
    assert (a.open, a.high, a.low, a.close, a.volume, a.number_of_trades) == (100, 101, 99, 100.5, 5.0, 4)
    assert (b.open, b.high, b.low, b.close, b.volume, b.number_of_trades) == (100.5, 102, 98, 101, 7.0, 4)
    assert a.vwap == pytest.approx((100 + 202 + 148.5 + 50.25) / 5)


def test_bars_on_every_row(trades):
    out = bars.with_bars(trades, MINUTE)
    assert out.count() == 8
    assert out.select("volume").distinct().count() == 2
    assert [r.n for r in out.groupBy("volume").agg(F.count("*").alias("n")).collect()] == [4, 4]


def test_bars_without_prices(trades):
    out = bars.with_bars(trades.drop("last_trade_px"), MINUTE)
    assert out.filter(F.col("open").isNotNull()).count() == 0


def test_bar_invariants(trades):
    out = bars.trade_bars(trades, MINUTE, "last_trade_px", "last_trade_qty")
    inside = (F.col("low") <= F.least("open", "close")) & (F.col("high") >= F.greatest("open", "close"))
    assert out.filter(~inside).count() == 0
    assert out.agg(F.sum("volume")).first()[0] == trades.agg(F.sum("last_trade_qty")).first()[0]


def test_snapshot_bars(spark):
    df = spark.range(20).select(
        F.lit("A").alias("symbol"), (F.lit(BASE) + F.col("id") * 100_000).alias("ts"), F.col("id").alias("seq"),
        (100 + F.col("id") * 0.1).alias("midprice"), F.lit(1.0).alias("taker_buy_volume"), F.lit(0.5).alias("taker_sell_volume"),
    )
    out = bars.snapshot_bars(df, 1_000_000).orderBy("ts").collect()
    assert len(out) == 2 and out[0].volume == 15.0
    with pytest.raises(ValueError):
        bars.snapshot_bars(df.drop("midprice"), 1_000_000)


@pytest.fixture(scope="module")
def hour(spark):
    i = F.col("id")
    return spark.range(36_000).select(
        F.lit("A").alias("symbol"), (F.lit(BASE) + i * 100_000).alias("ts"), i.alias("seq"),
        (100.0 + i * 0.001).alias("midprice"), F.lit(0.1).alias("spread"), F.lit(0.0).alias("ofi"), F.lit(0.1).alias("imbalance"),
        (100.0 + i * 0.001).alias("microprice"), F.lit(1.0).alias("taker_buy_volume"), F.lit(0.5).alias("taker_sell_volume"),
    )


def test_hour_has_sixty_buckets(hour):
    out = bars.bucket_aggregate(hour, MINUTE, version=1).orderBy("ts")
    first = out.first()
    assert out.count() == 60 and first.taker_buy_volume == 600.0 and first.number_of_trades == 600
    assert bars.bucket_aggregate(hour, 5 * MINUTE).count() == 12


@pytest.fixture(scope="module")
def book(spark):
    rng = np.random.default_rng(5)
    n = 500
    pdf = pd.DataFrame({"symbol": np.where(np.arange(n) % 3 == 0, "A", "B"), "ts": BASE + np.arange(n) * 100_000, "seq": np.arange(n)})
    for i in range(1, 11):
        pdf[f"bid_px_{i:02d}"] = 100 - i * 0.5 + rng.integers(0, 2, n) * 0.1
        pdf[f"ask_px_{i:02d}"] = 100 + i * 0.5 + rng.integers(0, 2, n) * 0.1
        pdf[f"bid_sz_{i:02d}"] = rng.integers(1, 50, n).astype(float)
        pdf[f"ask_sz_{i:02d}"] = rng.integers(1, 50, n).astype(float)
    pdf["taker_buy_vol"] = rng.integers(0, 5, n).cumsum().astype(float)
    pdf["taker_sell_vol"] = rng.integers(0, 5, n).cumsum().astype(float)
    return pdf


def expected_kyle(group, w=100):
    mid = (group.bid_px_01 + group.ask_px_01) / 2
    dp, sv = mid.diff(), group.taker_buy_vol - group.taker_sell_vol
    a, b = dp - dp.rolling(w).mean(), sv - sv.rolling(w).mean()
    cov, var = (a * b).rolling(w).mean(), (b * b).rolling(w).mean()
    return (cov / var).where(var > 0, 0.0)


@pytest.mark.parametrize("order", [DEFAULT, DEFAULT.blocks(256)], ids=["plain", "blocks"])
def test_features_against_pandas(spark, book, order):
    got = features.all_features(spark.createDataFrame(book), order).toPandas().sort_values("seq").reset_index(drop=True)
    for symbol, mine in book.groupby("symbol"):
        ours = got[got.symbol == symbol]
        ofi = mine.bid_sz_01.diff() - mine.ask_sz_01.diff()
        ret = np.log((mine.bid_px_01 + mine.ask_px_01) / 2).diff()
        sums = {s: mine[f"taker_{s}_vol"].rolling(50).sum() for s in ("buy", "sell")}
        vpin = ((sums["buy"] - sums["sell"]).abs() / (sums["buy"] + sums["sell"])).fillna(0.0)
        vol = ret.rolling(20).std()
        for name, values in {
            "ofi": ofi, "ofi_10": ofi.rolling(10).sum(), "ofi_cumulative": ofi.cumsum(), "returns": ret,
            "volatility_20": vol, "volatility_100": ret.rolling(100).std(), "vol_of_vol": vol.rolling(50).std(),
            "kyle_lambda": expected_kyle(mine), "vpin": vpin,
        }.items():
            assert np.allclose(ours[name].astype(float), values.astype(float), equal_nan=True, atol=1e-9), name


def test_version_columns(spark, book):
    df = spark.createDataFrame(book)
    v1, v2 = features.all_features(df, version=1).columns, features.all_features(df).columns
    assert "ofi_enhanced" in v2 and "ofi_enhanced" not in v1 and "_schema_version" in v2
    assert {"imbalance", "liquidity_10", "volume_imbalance"} <= set(v1) & set(v2)


def test_fills(spark):
    df = spark.createDataFrame([("A", i, i, x) for i, x in enumerate([None, 1.0, None, 2.0, None])], "symbol string, ts bigint, seq bigint, x double")
    forward = [r.x for r in features.forward_fill(df, ["x"]).orderBy("ts").collect()]
    backward = [r.x for r in features.backward_fill(df, ["x"]).orderBy("ts").collect()]
    assert forward == [None, 1, 1, 2, 2] and backward == [1, 1, 2, 2, None]


def test_bars_are_hash_aggregates(spark):
    rows = spark.createDataFrame(
        [("a", 0, -3, 1.0, 2.0), ("a", 0, 5, 3.0, 1.0), ("a", 7, None, 2.0, 1.0), ("a", 7, -9, 4.0, 1.0), ("b", -1, 2**63 - 1, 8.0, 1.0),
         ("b", -1, -(2**63), 9.0, 1.0), ("b", -5, 0, 7.0, 1.0)], "symbol string, ts bigint, seq bigint, price double, qty double")
    out = bars.trade_bars(rows, 10)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    got = {(r.symbol, r.bucket): (r.open, r.close) for r in out.collect()}
    assert got == {("a", 0): (1.0, 4.0), ("b", -10): (7.0, 8.0)}
    wide = rows.withColumnsRenamed({"price": "midprice", "qty": "bid_px_01"})
    for version in (1, 2):
        plan = bars.bucket_aggregate(wide, 10, version)._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan
