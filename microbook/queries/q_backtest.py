"""Queries on signals, profit and loss, metrics and models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from microbook.operators import backtest, models
from microbook.plans.ordered import DEFAULT, over_rows
from microbook.queries.q_training import training_table
from microbook.queries.q_features import MID, W, _sum
from microbook.queries.registry import query, snap_sql, snapped, with_ctes
from microbook.queries.tables import CLEAN, PREDICTIONS, TRADES, predictions, stored, trades

COST = 0.5


@query("signals", with_ctes(PREDICTIONS, """select symbol, ts, seq, case when y_pred > 0.5 then 1.0::double when y_pred < -0.5 then -1.0::double else 0.0::double end as threshold,
 least(greatest(y_pred * 0.25::double, -1.0::double), 1.0::double) as proportional, sign(y_pred)::double as by_sign from preds"""))
def signals(spark, sf):
    """Threshold, proportional and sign positions."""
    p = F.col("y_pred")
    return predictions(spark, sf).select(
        "symbol", "ts", "seq", backtest.threshold_signal(p).alias("threshold"),
        backtest.proportional_signal(p, 0.25).alias("proportional"), backtest.sign_signal(p).alias("by_sign"),
    )


@query("decisions", with_ctes(TRADES, """select symbol, ts, seq, case when move > 0.001::double then 'BUY' when move < -0.001::double then 'SELL' else 'HOLD' end as action,
 floor(move * 1e6::double + 0.5003::double) / 1e6::double as error from (
 select *, (nxt - price) / nullif(price, 0) as move from (select *, lead(price) over (partition by symbol order by ts, seq) as nxt from trades))"""))
def decisions(spark, sf):
    """BUY, SELL or HOLD by the move to the next price, and the relative error."""
    t = over_rows(trades(spark, sf), lambda d, w: d.withColumn("nxt", F.lead("price").over(w)), ahead=1)
    out = t.select(
        "symbol", "ts", "seq", backtest.decision(F.col("price"), F.col("nxt")).alias("action"),
        backtest.prediction_error(F.col("nxt"), F.col("price")).alias("error"),
    )
    return snapped(out, "error")


PNL = """sig as (select *, case when y_pred > 0.5 then 1.0::double when y_pred < -0.5 then -1.0::double else 0.0::double end as signal from preds),
pp as (select *, row_number() over w as rn, count(*) over (partition by symbol) as n, lag(signal) over w as prev from sig window w as (partition by symbol order by ts, seq)),
net as (select *, case when rn = 1 then 0 else prev * y - case when rn < n then abs(signal - prev) * 0.5::double else 0 end end as net_return, coalesce(signal <> prev, false) as is_trade from pp),
cum as (select *, sum(net_return) over (partition by symbol order by ts, seq rows unbounded preceding) as cumulative_pnl from net)"""
PNL_SELECT = "select symbol, ts, seq, net_return, is_trade, cumulative_pnl from cum"


def _pnl(spark, sf, order=DEFAULT):
    df = predictions(spark, sf).withColumn("signal", backtest.threshold_signal(F.col("y_pred")))
    return backtest.pnl(df, cost=COST, order=order)


@query("pnl", with_ctes(PREDICTIONS + ", " + PNL, PNL_SELECT))
def pnl(spark, sf):
    """Net return, trades and cumulative profit of threshold positions."""
    return _pnl(spark, sf).select("symbol", "ts", "seq", "net_return", "is_trade", "cumulative_pnl")


@query("pnl_blocks", with_ctes(PREDICTIONS + ", " + PNL, PNL_SELECT))
def pnl_blocks(spark, sf):
    """The same with symbols cut into blocks of 256 rows."""
    return _pnl(spark, sf, DEFAULT.blocks(256)).select("symbol", "ts", "seq", "net_return", "is_trade", "cumulative_pnl")


PERF = """pk as (select *, max(cumulative_pnl) over (partition by symbol order by ts, seq rows unbounded preceding) - cumulative_pnl as dd from cum)"""


@query("performance", with_ctes(PREDICTIONS + ", " + PNL + ", " + PERF, f"""select symbol, sum(net_return) as total_return,
 {snap_sql('avg(net_return) / stddev_pop(net_return) * sqrt(217728000.0::double)', 'sharpe_ratio', 3)},
 {snap_sql('avg(net_return) / stddev_pop(case when net_return < 0 then net_return end) * sqrt(217728000.0::double)', 'sortino_ratio', 3)},
 max(dd) as max_drawdown, {snap_sql('count(*) filter (where net_return > 0) / count(*) filter (where net_return <> 0)::double', 'win_rate')},
 {snap_sql('sum(case when net_return > 0 then net_return else 0 end) / -sum(case when net_return < 0 then net_return else 0 end)', 'profit_factor')},
 count(*) filter (where is_trade) as n_trades from pk group by 1"""))
def performance(spark, sf):
    """Sharpe, Sortino, drawdown, win rate and profit factor."""
    out = snapped(backtest.performance(_pnl(spark, sf)), "win_rate", "profit_factor")
    return snapped(out, "sharpe_ratio", "sortino_ratio", digits=3)


@query("regression_metrics", with_ctes(PREDICTIONS, f"""select symbol, {snap_sql('avg((y - y_pred) * (y - y_pred))', 'mse', 3)}, {snap_sql('sqrt(avg((y - y_pred) * (y - y_pred)))', 'rmse', 3)},
 {snap_sql('avg(abs(y - y_pred))', 'mae', 3)}, {snap_sql('1 - sum((y - y_pred) * (y - y_pred)) / (var_pop(y) * count(*))', 'r2')} from preds group by 1"""))
def regression_metrics(spark, sf):
    out = backtest.regression_metrics(predictions(spark, sf), ("symbol",))
    return snapped(snapped(out, "r2"), "mse", "rmse", "mae", digits=3)


def _direction_sql(t: str) -> str:
    a = f"case when y > {t} then 1 when y < -{t} then -1 else 0 end"
    p = f"case when y_pred > {t} then 1 when y_pred < -{t} then -1 else 0 end"
    return f"""select symbol, {snap_sql('count(*) filter (where a = p) / count(*)::double', 'directional_accuracy')},
 {snap_sql('coalesce(count(*) filter (where a > 0 and p > 0) / nullif(count(*) filter (where a > 0), 0)::double, 0)', 'up_accuracy')},
 {snap_sql('coalesce(count(*) filter (where a < 0 and p < 0) / nullif(count(*) filter (where a < 0), 0)::double, 0)', 'down_accuracy')},
 count(*) filter (where a > 0) as up_count, count(*) filter (where a < 0) as down_count, count(*) filter (where a = 0) as flat_count,
 {snap_sql('max(t)', 'threshold_used')} from (select *, {a} as a, {p} as p from thr) group by 1"""


@query("directional_sign", with_ctes(PREDICTIONS + ", thr as (select *, 0.0::double as t from preds)", _direction_sql("t")))
def directional_sign(spark, sf):
    out = backtest.directional_accuracy(predictions(spark, sf), ("symbol",))
    return snapped(out, "directional_accuracy", "up_accuracy", "down_accuracy", "threshold_used")


@query("directional_threshold", with_ctes(PREDICTIONS + ", thr as (select *, 4.0::double as t from preds)", _direction_sql("t")))
def directional_threshold(spark, sf):
    out = backtest.directional_accuracy(predictions(spark, sf), ("symbol",), 4.0)
    return snapped(out, "directional_accuracy", "up_accuracy", "down_accuracy", "threshold_used")


@query("directional_percentile", with_ctes(PREDICTIONS + ", thr as (select *, quantile_cont(abs(y), 0.33) over (partition by symbol) as t from preds)", _direction_sql("t")))
def directional_percentile(spark, sf):
    """Threshold at the 33rd percentile of |actual|."""
    out = backtest.directional_accuracy(predictions(spark, sf), ("symbol",), "percentile")
    return snapped(out, "directional_accuracy", "up_accuracy", "down_accuracy", "threshold_used")


TRADING = """tr as (select *, sign(y_pred)::double as pos, abs(sign(y_pred) - lag(sign(y_pred), 1, 0) over (partition by symbol order by ts, seq))::double as chg from preds),
tn as (select *, y * pos - chg * 0.5::double as net from tr),
tc as (select *, sum(net) over (partition by symbol order by ts, seq rows unbounded preceding) as cum from tn),
td as (select *, max(cum) over (partition by symbol order by ts, seq rows unbounded preceding) - cum as dd from tc)"""


@query("trading_metrics", with_ctes(PREDICTIONS + ", " + TRADING, f"""select symbol, sum(net) as total_pnl_bps, {snap_sql('avg(net) / stddev_pop(net) * sqrt(362880.0::double)', 'sharpe_ratio', 3)},
 max(dd) as max_drawdown_bps, {snap_sql('count(*) filter (where net > 0) / count(*) filter (where net <> 0)::double', 'win_rate')},
 {snap_sql('sum(case when net > 0 then net else 0 end) / -sum(case when net < 0 then net else 0 end)', 'profit_factor')},
 floor(sum(chg) / 2)::bigint as num_trades, {snap_sql('avg(net)', 'avg_return_bps', 3)} from td group by 1"""))
def trading_metrics(spark, sf):
    """Holding the predicted sign, costs in the unit of the returns."""
    out = backtest.trading_metrics(predictions(spark, sf), cost_bps=COST, returns_unit="bps")
    return snapped(snapped(out, "win_rate", "profit_factor"), "sharpe_ratio", "avg_return_bps", digits=3)


RET = """rr as (select symbol, ts, seq, y / 100000.0::double as r from preds),
eq as (select *, exp(sum(ln(1 + r)) over (partition by symbol order by ts, seq rows unbounded preceding)) as equity from rr),
ed as (select *, equity / max(equity) over (partition by symbol order by ts, seq rows unbounded preceding) - 1 as dd from eq)"""


def _returns(spark, sf):
    return predictions(spark, sf).select("symbol", "ts", "seq", (F.col("y") / 100000.0).alias("r"))


@query("compound_metrics", with_ctes(PREDICTIONS + ", " + RET, f"""select symbol, {snap_sql('arg_max(equity, (ts, seq)) - 1', 'total_return', 4)},
 {snap_sql('sqrt(8760.0::double) * avg(r) / stddev_pop(r)', 'sharpe_ratio', 3)}, {snap_sql('min(dd)', 'max_drawdown', 4)},
 {snap_sql('count(*) filter (where r > 0) / count(*)::double', 'win_rate')}, {snap_sql('sum(case when r > 0 then r else 0 end) / -sum(case when r < 0 then r else 0 end)', 'profit_factor')},
 count(*) as n_trades, {snap_sql('avg(r)', 'mean_return')}, {snap_sql('stddev_pop(r)', 'std_return')} from ed group by 1"""))
def compound_metrics(spark, sf):
    """Metrics of compounding returns."""
    out = backtest.compound_metrics(_returns(spark, sf))
    out = snapped(out, "win_rate", "profit_factor", "mean_return", "std_return")
    return snapped(snapped(out, "sharpe_ratio", digits=3), "total_return", "max_drawdown", digits=4)


@query("portfolio_returns", with_ctes(TRADES, f"""select symbol, ts, seq, {snap_sql('coalesce(v / lag(v) over w - 1, 0)', 'step_return')},
 {snap_sql('v / first_value(v) over w - 1', 'cumulative_return')} from (select *, 10000 + price as v from trades) window w as (partition by symbol order by ts, seq)"""))
def portfolio_returns(spark, sf):
    """Step and cumulative return of a portfolio value."""
    df = trades(spark, sf).select("symbol", "ts", "seq", (F.lit(10000.0) + F.col("price")).alias("portfolio_value"))
    return snapped(backtest.portfolio_returns(df).drop("portfolio_value"), "step_return", "cumulative_return")


QL = ", ".join(f"avg(greatest((y - y_pred - {d}) * {q}::double, (y - y_pred - {d}) * ({q}::double - 1))) as loss_{n}" for n, q, d in (("low", 0.1, -5), ("mid", 0.5, 0), ("high", 0.9, 5)))


@query("pinball_loss", with_ctes(PREDICTIONS + f", ql as (select symbol, {QL} from preds group by 1)",
                                 "select symbol, " + ", ".join(snap_sql(f"loss_{n}", digits=3) for n in ("low", "mid", "high")) + ", " + snap_sql("(loss_low + loss_mid + loss_high) / 3", "loss", 3) + " from ql"))
def pinball_loss(spark, sf):
    """Quantile losses of three predictions."""
    p = predictions(spark, sf).withColumns({"low": F.col("y_pred") - 5, "mid": F.col("y_pred"), "high": F.col("y_pred") + 5})
    out = backtest.pinball_loss(p, {"low": 0.1, "mid": 0.5, "high": 0.9}, keys=("symbol",))
    return snapped(out, "loss_low", "loss_mid", "loss_high", "loss", digits=3)


FOLDS = PREDICTIONS + """,
pf as (select *, (row_number() over (partition by symbol order by ts, seq) * 4 - 1) // (count(*) over (partition by symbol) + 1) as fold from preds),
fs as (select *, case when y_pred > 0.5 then 1.0::double when y_pred < -0.5 then -1.0::double else 0.0::double end as signal from pf),
fp as (select *, row_number() over w as rn, count(*) over (partition by symbol, fold) as n, lag(signal) over w as prev from fs window w as (partition by symbol, fold order by ts, seq)),
fnet as (select *, case when rn = 1 then 0 else prev * y - case when rn < n then abs(signal - prev) * 0.5::double else 0 end end as net_return from fp),
fc as (select *, sum(net_return) over (partition by symbol, fold order by ts, seq rows unbounded preceding) as c from fnet)"""


def _folded(spark, sf):
    from microbook.plans.ordered import row_index

    df = row_index(predictions(spark, sf), name="rn", total="n")
    fold = F.floor((F.col("rn") * 4 - 1) / (F.col("n") + 1)).cast("bigint")
    df = df.withColumn("fold", fold).drop("rn", "n").withColumn("signal", backtest.threshold_signal(F.col("y_pred")))
    return backtest.pnl(df, cost=COST, order=DEFAULT.by("symbol", "fold"))


@query("pnl_curve", with_ctes(FOLDS + """, ft as (select symbol, fold, sum(net_return) as e from fnet group by 1, 2),
 fo as (select *, coalesce(sum(e) over (partition by symbol order by fold rows between unbounded preceding and 1 preceding), 0) as o from ft)""",
 "select fc.symbol, fc.fold, rn - 1 as idx, c + o as cumulative_pnl from fc join fo on fo.symbol = fc.symbol and fo.fold = fc.fold"))
def pnl_curve(spark, sf):
    """Profit over four folds, each starting where the last ended."""
    return backtest.pnl_curve(_folded(spark, sf))


@query("fold_aggregate", with_ctes(FOLDS + """, fd as (select *, max(c) over (partition by symbol, fold order by ts, seq rows unbounded preceding) - c as dd from fc),
 pf2 as (select symbol, fold, sum(net_return) as total, max(dd) as dd, count(*) filter (where net_return > 0) / count(*) filter (where net_return <> 0)::double as win,
 count(*) filter (where signal <> prev) as trades from fd group by 1, 2)""", f"""select count(*) as n_splits, {snap_sql('stddev_pop(total)', 'std_total_return', 3)}, sum(trades)::bigint as total_trades,
 {snap_sql('avg(total)', 'avg_total_return', 3)}, {snap_sql('avg(dd)', 'avg_max_drawdown', 3)}, {snap_sql('avg(win)', 'avg_win_rate')} from pf2"""))
def fold_aggregate(spark, sf):
    """Means over folds."""
    out = backtest.aggregate_folds(backtest.performance(_folded(spark, sf), DEFAULT.by("symbol", "fold"))).drop("avg_sharpe")
    return snapped(snapped(out, "avg_win_rate"), "std_total_return", "avg_total_return", "avg_max_drawdown", digits=3)


@query("predictions_residual", with_ctes(PREDICTIONS, f"select ts, y as y_true, y_pred, {snap_sql('y - y_pred', 'residual')} from preds"))
def predictions_residual(spark, sf):
    """Prediction table as it is saved."""
    out = predictions(spark, sf).select("ts", F.col("y").alias("y_true"), "y_pred", (F.col("y") - F.col("y_pred")).alias("residual"))
    return snapped(out, "residual")


# --- models -----------------------------------------------------------------------------------


@query("model_least_squares", with_ctes(TRADES, f"""select symbol, ts, seq, {snap_sql('b0 + b1 * qty', 'y_pred', 4)} from trades, (select regr_intercept(price, qty) as b0, regr_slope(price, qty) as b1 from trades)"""))
def model_least_squares(spark, sf):
    """Least squares on one feature, predictions for all rows."""
    t = trades(spark, sf)
    model = models.fit_linear(t, ["qty"], "price", "linear")
    return snapped(models.predict(model, t, ["qty"]).select("symbol", "ts", "seq", "y_pred"), "y_pred", digits=4)


RIDGE = """m as (select count(*) as n, avg(qty) as mx, avg(price) as my, var_pop(qty) * count(*) as sxx, covar_pop(qty, price) * count(*) as sxy from trades)"""


@query("model_ridge", with_ctes(TRADES + ", " + RIDGE, f"select {snap_sql('sxy / (sxx + 1000.0::double)', 'slope')}, {snap_sql('my - sxy / (sxx + 1000.0::double) * mx', 'intercept', 4)} from m"))
def model_ridge(spark, sf):
    """Ridge with alpha 1000 on one feature: the closed form."""
    t = trades(spark, sf)
    model = models.fit_linear(t, ["qty"], "price", "ridge", {"alpha": 1000.0})
    out = t.agg(F.count(F.lit(1))).select(F.lit(float(model.coefficients[0])).alias("slope"), F.lit(float(model.intercept)).alias("intercept"))
    return snapped(snapped(out, "slope"), "intercept", digits=4)


MODEL_FEATURES = ["ofi", "imbalance", "spread", "imbalance_5"]


def model_table(spark, sf):
    """Feature rows with a return target over three rows; a null feature takes the last value before it, or 0."""
    from microbook.operators.dataset import create_target
    from microbook.operators.features import forward_fill

    def build():
        df = create_target(training_table(spark, sf), horizon=3).select("symbol", "ts", "seq", *MODEL_FEATURES, "target")
        return forward_fill(df, MODEL_FEATURES).fillna(0.0, MODEL_FEATURES).dropna(subset=["target"])

    return stored(spark, sf, "model_rows", build)


def _features_sql() -> dict[str, str]:
    bids, asks = _sum("bid", 5), _sum("ask", 5)
    return {
        "ofi": "bid_sz_01 - lag(bid_sz_01) over w - (ask_sz_01 - lag(ask_sz_01) over w)",
        "imbalance": "(bid_sz_01 - ask_sz_01) / nullif(bid_sz_01 + ask_sz_01, 0)", "spread": "ask_px_01 - bid_px_01",
        "imbalance_5": f"({bids} - {asks}) / nullif({bids} + {asks}, 0)",
    }


P = len(MODEL_FEATURES)
MODEL_ROWS = CLEAN + ", mf as (select symbol, ts, seq, " + ", ".join(f"{e} as {f}" for f, e in _features_sql().items()) + f""",
  (lead({MID}, 3) over w - {MID}) / ({MID}) * 10000 as y from book {W}),
ml as (select symbol, ts, seq, y, """ + ", ".join(
    f"coalesce(last_value({f} ignore nulls) over (partition by symbol order by ts, seq), 0)::double as x{k}" for k, f in enumerate(MODEL_FEATURES)) + """ from mf),
mr as (select *, row_number() over (partition by symbol order by ts, seq) as rn, count(*) over (partition by symbol) as n from ml where y is not null)"""


def gram_sql(rows: str, by: str = "id") -> str:
    """Count, means and second moments (per row) of the columns x0.. and y of `rows`."""
    g = [f"covar_pop(x{min(a, b)}, x{max(a, b)}) as g{a}{b}" for a in range(P) for b in range(P)] + [f"covar_pop(x{a}, y) as b{a}" for a in range(P)]
    return f"select {by}, count(*) as n, avg(y) as my, " + ", ".join([f"avg(x{a}) as m{a}" for a in range(P)] + g) + f" from {rows} group by {by}"


def descent_sql(rounds: int = 600) -> str:
    """`w`: coefficients w0.. and intercept b by coordinate descent for every row of `pts` (id, model, params, l1, l2; l2 null: alpha/n in `ridge`)."""
    start = ", ".join(f"0.0::double as w{k}" for k in range(P))
    inner = "cd"
    for k in range(P):
        rest = " - ".join([f"b{k}", *[f"g{k}{j} * w{j}" for j in range(P) if j != k]])
        pulled = f"(select *, {rest} as z from {inner})"
        inner = f"(select * exclude (z, w{k}), sign(z) * greatest(abs(z) - l1, 0) / (g{k}{k} + l2) as w{k} from {pulled})"
    names = ", ".join(["id", "model", "params", "l1", "l2", "my", *[f"m{k}" for k in range(P)], *[f"b{k}" for k in range(P)],
                       *[f"g{a}{b}" for a in range(P) for b in range(P)], *[f"w{k}" for k in range(P)]])
    cut = names[: names.rindex(f", w{0}")]
    return (f"cd as (select {cut}, {start}, 0 as it from pts join gram using (id) union all select {names}, it + 1 from {inner} where it < {rounds}),\n"
            f"w as (select id, model, params, my - " + " - ".join(f"w{k} * m{k}" for k in range(P)) + " as b, " + ", ".join(f"w{k}" for k in range(P))
            + f" from cd where it = {rounds})")


GUESS = "b + " + " + ".join(f"w{k} * x{k}" for k in range(P))


def points_sql(kinds: tuple[str, ...], grids: dict) -> str:
    """The penalties per row count of each grid point."""
    rows = []
    for kind in kinds:
        for params in grids[kind]:
            p = {**models.DEFAULTS[kind], **params}
            ratio = {"lasso": 1.0, "elasticnet": p.get("l1_ratio", 0)}.get(kind, 0.0)
            l1 = p["alpha"] * ratio if kind in ("lasso", "elasticnet") else 0.0
            l2 = f"{p['alpha']!r}::double / n" if kind == "ridge" else f"{p.get('alpha', 0.0) * (1 - ratio) if kind != 'linear' else 0.0!r}::double"
            text = str(params).replace("'", "''")
            rows.append(f"select id, '{kind}' as model, '{text}' as params, {l1!r}::double as l1, {l2} as l2 from gram")
    return "pts as (" + " union all ".join(rows) + ")"


COMPARED = ("recursive " + MODEL_ROWS + ", gram as (" + gram_sql("(select *, 0 as id from mr where ts < 1705900000000000)") + "), "
            + points_sql(tuple(models.DEFAULTS), {k: [{}] for k in models.DEFAULTS}) + ", " + descent_sql()
            + f", ps as (select model, y, {GUESS} as p from w, mr where ts >= 1705900000000000)")


@query("model_comparison", with_ctes(COMPARED, f"""select model, {snap_sql('avg((y - p) * (y - p))', 'mse')}, {snap_sql('sqrt(avg((y - p) * (y - p)))', 'rmse')},
 {snap_sql('avg(abs(y - p))', 'mae')}, {snap_sql('1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))', 'r2')},
 count(*) filter (where sign(y) = sign(p)) / count(*)::double as directional_accuracy from ps group by 1"""))
def model_comparison(spark, sf):
    """Four linear models fitted on the first three weeks, scored on the rest."""
    df = model_table(spark, sf)
    cut = 1_705_900_000_000_000
    out = models.compare_linear(df.filter(F.col("ts") < cut), df.filter(F.col("ts") >= cut), MODEL_FEATURES)
    return snapped(out, "mse", "rmse", "mae", "r2")


SEARCHED = ("ridge", "lasso", "elasticnet")
FOLDED = """f5 as (select unnest(range(5)) as id),
fr as (select mr.*, f5.id, n - (n // 6) * (4 - f5.id) as e, n // 6 as t from mr, f5)"""
SEARCH = ("recursive " + MODEL_ROWS + ", " + FOLDED + ", gram as (" + gram_sql("(select * from fr where rn <= e - t)") + "), "
          + points_sql(SEARCHED, models.GRIDS) + ", " + descent_sql()
          + f", es as (select w.id, model, params, avg((y - ({GUESS})) * (y - ({GUESS}))) as mse from w join fr on fr.id = w.id and rn > e - t and rn <= e group by all)")


@query("model_search", with_ctes(SEARCH, f"select model, params, {snap_sql('avg(mse)', 'mse', 5)} from es group by 1, 2"))
def model_search(spark, sf):
    """Ridge, lasso and elastic net penalties over expanding folds, best first in each kind."""
    return snapped(models.search_linear(model_table(spark, sf), MODEL_FEATURES, kind=SEARCHED), "mse", digits=5)


@query("model_boosted_importance")
def model_boosted_importance(spark, sf):
    """Boosted trees with early stopping on the tail; features by importance."""
    from microbook.operators.splits import tail_validation

    df = tail_validation(model_table(spark, sf))
    model = models.fit_boosted(df, MODEL_FEATURES, validation="is_validation")
    return models.importance(spark, model, MODEL_FEATURES)


def walk_sql(window: int | None) -> str:
    """Five splits: features clipped at five deviations of the training range and standardised, ridge, profit and metrics."""
    start = f"greatest(e - t - {window}, 0)" if window else "0"
    stats = ", ".join(f"avg(x{k}) as a{k}, case when stddev_samp(x{k}) > 0 then stddev_samp(x{k}) else 1 end as d{k}" for k in range(P))
    scaled = ", ".join(f"(least(greatest(x{k}, a{k} - 5 * d{k}), a{k} + 5 * d{k}) - a{k}) / d{k} as x{k}" for k in range(P))
    return ("recursive " + MODEL_ROWS + ", " + FOLDED + f""",
st as (select id, {stats} from fr where rn > {start} and rn <= e - t group by 1),
sc as (select symbol, ts, seq, id, rn, e, t, y, {scaled} from fr join st using (id) where rn > {start} and rn <= e),
gram as (""" + gram_sql("(select * from sc where rn <= e - t)") + "), " + points_sql(("ridge",), {"ridge": [{}]}) + ", " + descent_sql() + f""",
preds as (select symbol, id as fold, ts, seq, y, {GUESS} as y_pred from sc join w using (id) where rn > e - t),
sig as (select *, case when y_pred > 0.5 then 1.0::double when y_pred < -0.5 then -1.0::double else 0.0::double end as signal from preds),
pp as (select *, row_number() over w as rn, count(*) over (partition by symbol, fold) as n, lag(signal) over w as prev from sig window w as (partition by symbol, fold order by ts, seq)),
net as (select *, case when rn = 1 then 0 else prev * y - case when rn < n then abs(signal - prev) * 0.1::double else 0 end end as r, coalesce(signal <> prev, false) as is_trade from pp),
cum as (select *, sum(r) over (partition by symbol, fold order by ts, seq rows unbounded preceding) as c from net),
dd as (select *, max(c) over (partition by symbol, fold order by ts, seq rows unbounded preceding) - c as down from cum),
res as (select symbol, fold::int as fold, sum(r) as total, max(down) as drop, count(*) filter (where r > 0) as wins, count(*) filter (where r <> 0) as moves,
  coalesce(sum(r) filter (where r > 0), 0) as gain, coalesce(-sum(r) filter (where r < 0), 0) as loss, avg(r) as mean, stddev_pop(r) as dev,
  coalesce(stddev_pop(r) filter (where r < 0), 0) as low, count(*) filter (where is_trade) as n_trades, avg((y - y_pred) * (y - y_pred)) as mse, avg(abs(y - y_pred)) as mae,
  case when var_pop(y) > 0 then 1 - sum((y - y_pred) * (y - y_pred)) / (var_pop(y) * count(*)) else 0 end as r2,
  count(*) filter (where sign(y) = sign(y_pred)) / count(*)::double as directional_accuracy from dd group by 1, 2)""")


def walk_select() -> str:
    root = f"sqrt({float(backtest.TICKS_100MS)!r}::double)"
    sharpe = f"case when dev > 0 then mean / dev * {root} else 0 end"
    out = {
        "total_return": "total", "sharpe_ratio": sharpe, "sortino_ratio": f"case when low > 0 then mean / low * {root} else {sharpe} end",
        "max_drawdown": "drop", "win_rate": "wins / nullif(moves, 0)::double", "profit_factor": "case when loss > 0 then gain / loss else 'inf'::double end",
    }
    traded = [snap_sql(f"case when moves > 0 then {e} else 0 end", c, 3) for c, e in out.items()]
    scores = [snap_sql("mse", digits=4), snap_sql("sqrt(mse)", "rmse", 4), snap_sql("mae", digits=4), snap_sql("r2", digits=4), "directional_accuracy"]
    return "select symbol, fold, n_trades, " + ", ".join(traded + scores) + " from res"


def _walked(spark, sf, window: int | None):
    out = models.fold_results(models.walk_forward_backtest(model_table(spark, sf), MODEL_FEATURES, train_window=window))
    out = snapped(out, "total_return", "sharpe_ratio", "sortino_ratio", "max_drawdown", "win_rate", "profit_factor", digits=3)
    return snapped(out, "mse", "rmse", "mae", "r2", digits=4)


@query("walk_forward_backtest", with_ctes(walk_sql(None), walk_select()))
def walk_forward_backtest(spark, sf):
    """Ridge trained on the past, scored on the next block, five times; results per fold."""
    return _walked(spark, sf, None)


@query("walk_forward_rolling", with_ctes(walk_sql(120), walk_select()))
def walk_forward_rolling(spark, sf):
    """The same with training windows of the last 120 rows of each symbol."""
    return _walked(spark, sf, 120)
