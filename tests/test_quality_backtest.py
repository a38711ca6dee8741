"""Cleaning, checks, profit and metrics against plain Python."""

import json
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from microbook.operators import backtest, dataset, models, moments, normalize, quality, splits
from microbook.plans.ordered import DEFAULT, Order

BLOCKS = DEFAULT.blocks(64)


@pytest.fixture(scope="module")
def quotes():
    rng = random.Random(2)
    rows = []
    for i in range(600):
        bid = None if rng.random() < 0.05 else 100.0 + rng.randrange(10)
        ask = None if rng.random() < 0.05 else 103.0 + rng.randrange(20)
        rows.append(("A", 0 if rng.random() < 0.03 else 1000 * i - rng.choice([0, 0, 5000]), i, bid, ask))
    return rows


def clean(rows, stale=3000):
    seen, out = 0, []
    for _, ts, _, bid, ask in rows:
        reason, old = None, False
        if ts <= 0 or (seen and ts < seen):
            reason = "timestamp"
        else:
            old = bool(seen) and ts - seen > stale
            if bid is None or ask is None:
                reason = "price"
            elif bid >= ask or (ask - bid) / bid > 0.1:
                reason = "spread"
        if reason is None:
            seen = ts
        out.append((reason, old))
    return out


@pytest.mark.parametrize("rows_per_block", [None, 64])
def test_clean_flags(spark, quotes, rows_per_block):
    df = spark.createDataFrame(quotes, "symbol string, ts bigint, seq bigint, bid_px_01 double, ask_px_01 double")
    arrival = Order(("symbol",), "seq", (), rows_per_block, 3600)
    got = quality.clean_flags(df, order=arrival, time="ts", max_staleness_us=3000).orderBy("seq").collect()
    wanted = clean(quotes)
    assert [r.reject_reason for r in got] == [w[0] for w in wanted]
    valid = [i for i, w in enumerate(wanted) if w[0] != "timestamp"]
    assert [got[i].stale for i in valid] == [wanted[i][1] for i in valid]


def test_fill_limited_by_gaps(spark):
    rng = random.Random(4)
    times, t = [], 0
    for _ in range(300):
        t += rng.choice([500, 900, 1500])
        times.append(t)
    values = [None if rng.random() < 0.5 else float(i) for i in range(300)]
    wanted = list(values)
    for i in range(1, 300):
        if wanted[i] is None and times[i] - times[i - 1] <= 1000:
            wanted[i] = wanted[i - 1]
    df = spark.createDataFrame([("A", a, i, b) for i, (a, b) in enumerate(zip(times, values))], "symbol string, ts bigint, seq bigint, x double")
    for order in (DEFAULT, BLOCKS):
        got = quality.forward_fill_gaps(df, "x", 1000, order).orderBy("seq").collect()
        assert [r.x for r in got] == wanted


def test_outliers(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert {r.x for r in quality.outlier_mask(df, "x").filter("is_valid").collect()} == {1.0, 2.0, 3.0, 4.0}
    same = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    assert quality.outlier_mask(same, "x", "zscore").filter("is_valid").count() == 2
    with pytest.raises(ValueError):
        quality.outlier_mask(df, "x", "other")


def test_message_reasons(spark):
    full = {"exchange_ts": 1, "local_ts": 1, "type": "depth", "symbol": "A", "bids": [["1", "2"]], "asks": []}
    trade = {**{k: full[k] for k in ("exchange_ts", "local_ts", "symbol")}, "type": "trade", "trade": {"trade_id": 1, "price": "1", "quantity": "1"}}
    cases = [
        (json.dumps(full), None), (json.dumps(trade), None), (json.dumps({"_header": {"version": "2.0"}}), None),
        (json.dumps({**full, "bids": [["1"]]}), "invalid bid format"), (json.dumps({**full, "asks": [["1", "x"]]}), "invalid ask values"),
        (json.dumps({**full, "bids": [["1", "x"], ["1"]]}), "invalid bid values"), (json.dumps({**full, "asks": [["1"], ["x", "1"]]}), "invalid ask format"),
        (json.dumps({k: v for k, v in full.items() if k != "asks"}), "missing required field: asks"),
        (json.dumps({**trade, "trade": {"trade_id": 1}}), "missing trade field: price"),
        (json.dumps({"type": "x"}), "unknown message type: x"), ("{broken", "JSON parse error"),
    ]
    df = spark.createDataFrame(cases, "line string, wanted string")
    for r in df.withColumn("got", quality.message_reason(F.col("line"))).collect():
        assert r.got == r.wanted, r.line


def test_schema_findings(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "ts int, midprice double, spread string")
    found = quality.schema_findings(df)
    assert ("type", "ts") in found and ("type", "spread") in found and ("missing", "ofi_10") in found
    with pytest.raises(ValueError):
        quality.training_readiness(df)


def expected_pnl(s, r, cost):
    earned = np.concatenate([[0], s[:-1] * r[1:]])
    moves = np.abs(np.diff(s))
    return earned - np.concatenate([[0], moves[:-1] * cost, [0]])[: len(earned)], int((moves > 0).sum())


@pytest.mark.parametrize("order", [DEFAULT, BLOCKS], ids=["plain", "blocks"])
def test_pnl_and_performance(spark, order):
    rng = np.random.default_rng(9)
    n = 300
    pdf = pd.DataFrame({"symbol": "A", "ts": np.arange(n), "seq": np.arange(n), "signal": rng.integers(-1, 2, n).astype(float), "y": rng.normal(size=n)})
    net, trades = expected_pnl(pdf.signal.to_numpy(), pdf.y.to_numpy(), 0.1)
    out = backtest.pnl(spark.createDataFrame(pdf), order=order)
    got = out.orderBy("ts").toPandas()
    assert np.allclose(got.net_return, net) and np.allclose(got.cumulative_pnl, net.cumsum())
    row = backtest.performance(out, order).first()
    cum = net.cumsum()
    assert row.n_trades == trades
    assert row.total_return == pytest.approx(cum[-1])
    assert row.max_drawdown == pytest.approx((np.maximum.accumulate(cum) - cum).max())
    assert row.sharpe_ratio == pytest.approx(net.mean() / net.std() * math.sqrt(252 * 24 * 60 * 60 * 10))
    assert row.sortino_ratio == pytest.approx(net.mean() / net[net < 0].std() * math.sqrt(252 * 24 * 60 * 60 * 10))
    assert row.win_rate == pytest.approx((net > 0).sum() / (net != 0).sum())
    assert row.profit_factor == pytest.approx(net[net > 0].sum() / -net[net < 0].sum())


def test_no_losses_and_no_moves(spark):
    df = spark.createDataFrame([("A", i, i, 1.0, 1.0) for i in range(3)], "symbol string, ts bigint, seq bigint, signal double, y double")
    assert backtest.performance(backtest.pnl(df)).first().profit_factor == math.inf
    flat = df.withColumn("signal", F.lit(0.0))
    assert backtest.performance(backtest.pnl(flat)).first().sharpe_ratio == 0.0


@pytest.fixture(scope="module")
def regression(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 3))
    y = x @ np.array([1.0, -2.0, 0.0]) * 5 + 3 + rng.normal(size=200)
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(target=y, symbol="A", ts=range(200), seq=range(200))
    return x, y, spark.createDataFrame(pdf).cache()


def test_ridge_is_the_closed_form(regression):
    x, y, df = regression
    model = models.fit_linear(df, ["a", "b", "c"], kind="ridge", params={"alpha": 25.0})
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + 25.0 * np.eye(3), xc.T @ yc)
    assert np.allclose(model.coefficients.toArray(), w, rtol=1e-6)
    assert model.intercept == pytest.approx(y.mean() - x.mean(0) @ w)


@pytest.mark.parametrize("kind,params", [("lasso", {"alpha": 0.5}), ("elasticnet", {"alpha": 0.5, "l1_ratio": 0.3})])
def test_penalised_models_meet_their_conditions(regression, kind, params):
    x, y, df = regression
    w = models.fit_linear(df, ["a", "b", "c"], kind=kind, params=params).coefficients.toArray()
    ratio = 1.0 if kind == "lasso" else params["l1_ratio"]
    xc, yc = x - x.mean(0), y - y.mean()
    slope = xc.T @ (yc - xc @ w) / len(y) - params["alpha"] * (1 - ratio) * w
    for g, c in zip(slope, w):
        if c:
            assert g == pytest.approx(params["alpha"] * ratio * np.sign(c), abs=1e-3)
        else:
            assert abs(g) <= params["alpha"] * ratio + 1e-3


def test_unknown_model(regression):
    with pytest.raises(ValueError):
        models.fit_linear(regression[2], ["a"], kind="forest")


def test_walk_forward_trains_on_the_past(spark, regression):
    folds = splits.walk_forward(regression[2], 3, 0.1, gap_rows=2)
    split = F.col("split")
    ends = folds.groupBy("fold").agg(
        F.max(F.when(split == "train", F.col("ts"))).alias("trained_to"), F.min(F.when(split == "test", F.col("ts"))).alias("tested_from"),
        F.count_if(split == "test").alias("n_test"))
    for r in ends.collect():
        assert r.trained_to + 2 < r.tested_from and r.n_test == 20


def test_segments_of_a_gap(spark):
    i = F.col("id")
    df = spark.range(10_000).select(F.lit("A").alias("symbol"), (i * 100_000 + F.when(i >= 5000, 60_000_000).otherwise(0)).alias("ts"), i.alias("seq"))
    segmented = splits.with_segments(df)
    assert [r.n_rows for r in splits.segments(segmented).orderBy("segment_id").collect()] == [5000, 5000]
    row = splits.split_summary(splits.segment_split(segmented)).first()
    assert (row.n_segments, row.total_train_rows, row.total_test_rows) == (2, 8000, 2000)
    crossing = splits.segment_split(segmented).groupBy("segment_id").agg(
        F.max(F.when(F.col("split") == "train", F.col("ts"))).alias("a"), F.min(F.when(F.col("split") == "test", F.col("ts"))).alias("b"))
    assert crossing.filter("a >= b").count() == 0


def test_scaling_round_trip(spark):
    df = spark.createDataFrame([(1.0, 5.0, 0.0), (2.0, 5.0, 3.0), (None, 5.0, 8.0)], "ofi double, spread double, bid_sz_01 double")
    manifest = normalize.fit(df)
    rows = {r.feature: r for r in manifest.collect()}
    assert rows["spread"].std == 1.0 and rows["ofi"].n_nulls == 1 and rows["bid_sz_01"].scaler == "robust"
    scaled = normalize.transform(df, manifest)
    back = normalize.inverse_standard(scaled, manifest, ["ofi", "spread"]).collect()
    assert [r.ofi for r in back][:2] == pytest.approx([1.0, 2.0]) and back[0].spread == 5.0
    with pytest.raises(ValueError):
        normalize.fit(df, training=False)


def test_targets(spark):
    df = spark.createDataFrame([("A", i, i, 100.0 + i) for i in range(5)], "symbol string, ts bigint, seq bigint, midprice double")
    assert [r.target for r in dataset.create_target(df, "price_delta", 2).orderBy("ts").collect()] == [2, 2, 2, None, None]
    assert [r.target for r in dataset.create_target(df, "direction", 1).orderBy("ts").collect()] == [1, 1, 1, 1, None]
    with pytest.raises(ValueError):
        dataset.create_target(df, "sideways")


@pytest.mark.parametrize("stride", [1, 3])
def test_sequence_count(spark, stride):
    df = spark.range(40).select(F.lit("A").alias("symbol"), F.col("id").alias("ts"), F.col("id").alias("seq"), F.col("id").cast("double").alias("v"))
    out = dataset.forecast_sequences(df, ["v"], ["v"], 10, 5, stride)
    assert out.count() == (40 - 15) // stride + 1
    first = out.orderBy("start_ts").first()
    assert [x[0] for x in first.x] == list(range(10)) and [y[0] for y in first.y] == list(range(10, 15))


def test_predictions_keep_rows_with_null_features(spark):
    rows = spark.createDataFrame([(float(i), None if i == 3 else float(i), 2.0 * i) for i in range(8)], "ts double, a double, target double")
    scored = models.predict(models.fit_linear(rows, ["a"], kind="linear"), rows, ["a"]).orderBy("ts").collect()
    assert len(scored) == 8 and scored[3].y_pred is None and abs(scored[5].y_pred - 10.0) < 1e-6


def test_model_queries_take_default_settings_and_every_grid(monkeypatch):
    from microbook.operators import models, splits
    from microbook.queries import q_backtest

    asked = []
    monkeypatch.setattr(q_backtest, "model_table", lambda spark, sf: None)
    monkeypatch.setattr(splits, "tail_validation", lambda df: df)
    monkeypatch.setattr(models, "fit_boosted", lambda *args, **named: asked.append(named))
    monkeypatch.setattr(models, "importance", lambda *args: None)
    q_backtest.model_boosted_importance(None, "")
    assert asked == [{"validation": "is_validation"}]
    monkeypatch.setattr(q_backtest, "snapped", lambda df, *columns, digits: df)
    monkeypatch.setattr(models, "search_linear", lambda df, features, kind: kind)
    assert q_backtest.model_search(None, "") == ("ridge", "lasso", "elasticnet")


def split_moments(spark, x, y, blocks):
    rows = [(int(b), *map(float, r), float(v)) for b, r, v in zip(blocks, x, y)]
    df = spark.createDataFrame(rows + [(0, None, 1.0, 1.0), (1, 1.0, float("nan"), 1.0)], "b bigint, p double, q double, y double")
    return moments.collected(df, ["p", "q", "y"], "b")


def test_block_moments_add_up_to_those_of_all_rows(spark):
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(400, 2)) * [1.0, 30.0] + [1e7, -5.0], rng.normal(size=400)
    parts = split_moments(spark, x, y, rng.integers(0, 7, 400))
    every, both = moments.total(parts.values(), 3), np.column_stack([x, y])
    assert every.n == 400 and np.allclose(every.mean, both.mean(0)) and np.allclose(every.low, both.min(0)) and np.allclose(every.high, both.max(0))
    assert np.allclose(every.co, (both - both.mean(0)).T @ (both - both.mean(0)), rtol=1e-7, atol=1e-6)
    half = every.scaled(np.array([1e7, 0, 0]), np.array([2.0, 1, 1]))
    assert np.allclose(half.co[0, 1] * 2, every.co[0, 1]) and half.mean[0] == pytest.approx((every.mean[0] - 1e7) / 2)
    model = moments.solve(every, 0.01, 0.02)
    assert model.squared_error(every) == pytest.approx(np.mean((y - x @ model.weights - model.intercept) ** 2))
    assert moments.nothing(3).n == 0 and (moments.nothing(3) + every).n == 400 and model.squared_error(moments.nothing(3)) is None


def test_dependent_features_take_the_shortest_least_squares(spark):
    x = np.arange(20.0)
    parts = split_moments(spark, np.column_stack([x, 2 * x]), 3 * x + 1, np.zeros(20))
    model = moments.solve(parts[0])
    assert np.allclose(model.weights, [0.6, 1.2]) and model.intercept == pytest.approx(1.0)


def test_too_many_blocks_are_refused(spark):
    df = spark.range(30).select(F.col("id").alias("b"), F.col("id").cast("double").alias("x"))
    with pytest.raises(ValueError):
        moments.collected(df, ["x"], "b", most=10)


@pytest.mark.parametrize("window,tests", [(None, None), (20, None), (15, 10)])
def test_roles_say_what_the_copied_folds_say(spark, window, tests):
    df = spark.range(170).select(F.when(F.col("id") < 130, "A").otherwise("B").alias("symbol"), F.col("id").alias("ts"), F.col("id").alias("seq"))
    copied = {(r.ts, r.fold, r.split) for r in splits.walk_forward_blocks(df, 4, window, tests).collect()}
    roles = splits.block_roles(df, 4, window, tests).collect()
    said = {(r.ts, i, name) for r in roles for i in range(4) for bit, name in ((0, "train"), (1, "test")) if r.roles >> (2 * i + bit) & 1}
    assert len(roles) == 170 and said == copied
    with pytest.raises(ValueError):
        splits.block_roles(df, 40)


@pytest.mark.parametrize("scale,clip,window", [("zscore", 2.0, None), ("zscore", None, 40), ("minmax", 3.0, 40), (None, 2.0, None), ("minmax", None, None)])
def test_walk_forward_from_moments_equals_a_fit_for_each_split(spark, regression, scale, clip, window):
    df = regression[2].withColumn("a", F.when(F.col("ts") % 17 == 3, None).when(F.col("ts") % 19 == 5, float("inf")).otherwise(F.col("a")))
    features = ["a", "b", "c"]
    one = models.walk_forward_backtest(df, features, n_splits=3, train_window=window, scale=scale, clip_std=clip)
    each = models.walk_forward_backtest(df, features, fit=models.fit_linear, n_splits=3, train_window=window, scale=scale, clip_std=clip)
    one, each = ({(r.symbol, r.fold, r.ts): (r.y_pred, r.cumulative_pnl) for r in d.collect()} for d in (one, each))
    assert one.keys() == each.keys() and len(one) > 50
    assert all(np.allclose(one[k], each[k], rtol=1e-7, atol=1e-7) for k in one)


def test_search_equals_a_fit_for_each_fold(spark, regression):
    df, features = regression[2], ["a", "b", "c"]
    found = {(r.model, r.params): r.mse for r in models.search_linear(df, features, kind=("ridge", "lasso"), n_splits=3).collect()}
    folds = splits.time_series_folds(df, 3)
    for kind in ("ridge", "lasso"):
        params, errors = models.GRIDS[kind][3], []
        for i in range(3):
            part = folds.where(F.col("fold") == i)
            model = models.fit_linear(part.where("split = 'train'"), features, kind=kind, params=params)
            err = F.col("target") - F.col("y_pred")
            errors.append(models.predict(model, part.where("split = 'test'"), features).agg(F.avg(err * err)).first()[0])
        assert found[kind, str(params)] == pytest.approx(np.mean(errors), rel=1e-7)
