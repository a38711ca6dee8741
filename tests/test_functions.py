"""Quantiles, rolling frames and time handling against other implementations."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from microbook.functions import timeutil
from microbook.functions.expr import add_rolling, clip, to_double
from microbook.functions.quantiles import exact_quantiles, quantiles, sortable
from microbook.plans.ordered import Order

BASE = 1_705_320_000_000_000


@pytest.mark.parametrize("n", [1, 2, 7, 1000])
def test_quantiles_match_numpy(spark, n):
    rng = np.random.default_rng(n)
    values = np.round(rng.normal(size=n), 1)
    df = spark.createDataFrame(pd.DataFrame({"k": np.arange(n) % 2, "x": values}))
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    one = exact_quantiles(df, "x", probs).first()
    assert np.allclose(list(one), np.quantile(values, list(probs.values())))
    for row in exact_quantiles(df, "x", probs, ("k",)).collect():
        mine = values[np.arange(n) % 2 == row.k]
        assert np.allclose(list(row)[1:], np.quantile(mine, list(probs.values())))


def test_quantile_nearest_and_nulls(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (None,)], "x double")
    row = exact_quantiles(df, "x", {"q": 0.25, "m": 0.5}, interpolation="nearest").first()
    assert (row.q, row.m) == (2.0, 2.0) or (row.q, row.m) == (1.0, 2.0)
    assert exact_quantiles(df.filter("x is null"), "x", {"q": 0.5}).count() == 0


def test_sortable_numbers_keep_the_order_of_doubles():
    x = np.array([-np.inf, -1e300, -1.5, -1e-310, -0.0, 0.0, 5e-324, 1e-310, 1.0, 1.0 + 2**-52, 1e300, np.inf, np.nan])
    numbers = sortable(x)
    assert numbers[4] == numbers[5] and (np.diff(numbers.astype(object)) >= 0).all() and len(set(numbers.tolist())) == len(x) - 1


def test_quantiles_of_many_columns_and_keys(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"k": rng.choice(["a", "b", "c"], 3000), "d": rng.integers(0, 2, 3000), "x": rng.normal(size=3000) * 10.0 ** rng.integers(-200, 200, 3000),
                        "y": np.round(rng.normal(size=3000), 1), "z": np.where(rng.random(3000) < 0.9, -7.25, np.nan)})
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "k string, d bigint, x double, y double, z double").repartition(5)
    probs, columns = {"lo": 0.013, "mid": 0.5, "hi": 0.87}, {"x": "x", "minus": -F.col("y"), "z": "z"}
    for keys in ((), ("k",), ("k", "d")):
        found = quantiles(df, columns, probs, keys, {"lo": "nearest", "mid": "linear", "hi": "linear"}).collect()
        groups = [((), pdf)] if not keys else list(pdf.groupby(list(keys)))
        assert len(found) == 3 * len(groups)
        for r in found:
            mine = next(g for key, g in groups if key == tuple(r[k] for k in keys))
            v = {"x": mine.x, "minus": -mine.y, "z": mine.z.dropna()}[r["column"]].to_numpy()
            at = np.sort(v)[int(np.floor(0.013 * (len(v) - 1) + 0.5))]
            assert r["n"] == len(v) and r["lo"] == at and np.allclose([r["mid"], r["hi"]], np.quantile(v, [0.5, 0.87]), rtol=1e-12)


@pytest.mark.parametrize("n", [1, 3, 17, 20, 50, 100, 120])
def test_rolling_matches_pandas(spark, n):
    rng = np.random.default_rng(3)
    x = rng.normal(100, 5, 400)
    x[[0, 150, 151]] = np.nan
    pdf = pd.DataFrame({"i": np.arange(400), "x": x})
    df = spark.createDataFrame(pdf).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    w = Window.partitionBy(F.lit(1)).orderBy("i")
    kinds = ["sum", "mean", "min", "max"] + (["std"] if n > 1 else [])
    got = add_rolling(df, w, {k: (k, F.col("x"), n) for k in kinds}).orderBy("i").toPandas()
    for kind in kinds:
        expected = getattr(pdf["x"].rolling(n, min_periods=n), kind)()
        assert np.allclose(got[kind].astype(float), expected, equal_nan=True), kind


@pytest.mark.parametrize("scale,unit", [(1, "us"), (1000, "ms"), (1_000_000, "s")])
def test_detect_unit(spark, scale, unit):
    df = spark.createDataFrame([(BASE // scale,), (BASE // scale + 1,)], "ts bigint")
    assert timeutil.detect_unit(df) == unit


def test_detect_unit_unknown(spark):
    assert timeutil.detect_unit(spark.createDataFrame([], "ts bigint")) == "unknown"
    assert timeutil.detect_unit(spark.createDataFrame([(1,)], "x bigint")) == "unknown"
    assert timeutil.detect_unit(spark.createDataFrame([(5,)], "ts bigint")) == "unknown"
    assert timeutil.detect_unit(spark.createDataFrame([(3 * 10**15,)], "ts bigint")) == "us"


def test_detect_unit_reads_all_rows(spark):
    early = [(BASE // 1_000_000,)] * 1500
    late = [(BASE + i,) for i in range(1501)]
    assert timeutil.detect_unit(spark.createDataFrame(early + late, "ts bigint").coalesce(1)) == "us"
    assert timeutil.detect_unit(spark.createDataFrame([(BASE // 1000,), (BASE // 1000,), (1,), (None,)], "ts bigint")) == "ms"


def test_normalize_timestamp(spark):
    ms = spark.createDataFrame([(BASE // 1000,)], "ts bigint")
    row = timeutil.normalize_timestamp(ms, both=True).first()
    assert (row.ts, row.ts_us, row.ts_ms) == (BASE, BASE, BASE // 1000)
    us = spark.createDataFrame([(BASE + 999,), (-1,)], "ts bigint")
    got = [r.ts for r in timeutil.normalize_timestamp(us, source="us", target="ms").collect()]
    assert got == [BASE // 1000, -1]


@pytest.mark.parametrize("n,step,buckets", [(10, 100_000, 1), (180, 1_000_000, 3), (600, 100_000, 1), (36_000, 100_000, 60)])
def test_minute_buckets(spark, n, step, buckets):
    df = spark.range(n).select((F.lit(BASE) + F.col("id") * step).alias("ts"))
    assert timeutil.add_bucket(df, 60_000).select("bucket").distinct().count() == buckets


@pytest.mark.parametrize("times,positions", [([100, 200, 300, 400], []), ([100, 200, 150, 400], [2]), ([1], [])])
def test_monotonicity(spark, times, positions):
    df = spark.createDataFrame([("A", t, i) for i, t in enumerate(times)], "symbol string, ts bigint, seq bigint")
    row = timeutil.order_violations(df, Order(("symbol",), "seq", ())).first()
    assert (row.violations, row.positions, row.is_monotonic) == (len(positions), positions, not positions)


def test_scalars(spark):
    one = spark.range(1)
    assert one.select(clip(F.lit(None).cast("double"), F.lit(0.0), F.lit(1.0))).first()[0] is None
    assert one.select(to_double(F.lit("12x"))).first()[0] is None
    assert one.select(timeutil.to_micros(timeutil.to_timestamp(F.lit(BASE)))).first()[0] == BASE
