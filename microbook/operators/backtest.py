"""Signals, profit and loss, and metrics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from microbook.functions.expr import clip, div
from microbook.functions.quantiles import exact_quantiles
from microbook.plans.ordered import DEFAULT, Order, join_small, layout, over_rows, row_index, running
from microbook.session import cut_lineage

# Periods per year used to annualise.
TICKS_100MS = 252 * 24 * 60 * 60 * 10
MINUTES = 252 * 24 * 60
HOURS = 525600 / 60

Strategy = Callable[[Column], Column]


def threshold_signal(prediction: Column, threshold: float = 0.5) -> Column:
    return F.when(prediction > threshold, 1.0).when(prediction < -threshold, -1.0).otherwise(0.0)


def proportional_signal(prediction: Column, scale: float = 1.0, limit: float = 1.0) -> Column:
    return clip(prediction * F.lit(scale), F.lit(-limit), F.lit(limit))


def sign_signal(prediction: Column) -> Column:
    return F.signum(prediction)


def decision(current: Column, predicted: Column, threshold: float = 0.001) -> Column:
    """BUY, SELL or HOLD by predicted return."""
    move = div(predicted - current, current)
    return F.when(move > threshold, "BUY").when(move < -threshold, "SELL").otherwise("HOLD")


def pnl(df: DataFrame, signal: str = "signal", actual: str = "y", cost: float = 0.1, order: Order = DEFAULT) -> DataFrame:
    """Add net_return, cumulative_pnl and is_trade.

    A row earns the previous signal times its own return and pays for the change of signal; the
    first row earns nothing and the last pays nothing.
    """
    plan = layout(df, order)
    df = row_index(df, order, "_rn", total="_n", plan=plan)
    s = F.col(signal)

    def build(d, w):
        d = d.withColumn("_prev", F.lag(s).over(w))
        change = F.abs(s - F.col("_prev"))
        paid = F.when(F.col("_rn") < F.col("_n"), change * F.lit(cost)).otherwise(0.0)
        earned = F.col("_prev") * F.col(actual) - paid
        return d.withColumns({
            "net_return": F.when(F.col("_rn") == 1, 0.0).otherwise(earned),
            "is_trade": F.coalesce(change > 0, F.lit(False)),
        })

    df = over_rows(df, build, order, back=1, plan=plan)
    df = running(df, {"cumulative_pnl": ("sum", F.col("net_return"))}, order, plan=plan)
    return df.drop("_rn", "_n", "_prev")


def performance(df: DataFrame, order: Order = DEFAULT, factor: float = TICKS_100MS) -> DataFrame:
    """Total return, Sharpe, Sortino, drawdown, win rate, profit factor and trades per key.

    Deviations are those of the population. Without a negative return's spread, Sortino is Sharpe;
    without losses the profit factor is infinite; all-zero returns give zeros.
    """
    plan = layout(df, order)
    if not plan.single:  # block totals below would replay the profit calculation
        df = cut_lineage(df.select(*order.keys, *order.columns, "net_return", "cumulative_pnl", "is_trade"))
    df = running(df, {"_peak": ("max", F.col("cumulative_pnl"))}, order, plan=plan)
    r = F.col("net_return")
    one = df.groupBy(*order.keys).agg(
        F.sum(r).alias("total"), F.avg(r).alias("mean"), F.stddev_pop(r).alias("dev"),
        F.stddev_pop(F.when(r < 0, r)).alias("down"), F.max(F.col("_peak") - F.col("cumulative_pnl")).alias("dd"),
        F.count_if(r > 0).alias("wins"), F.count_if(r != 0).alias("moves"),
        F.sum(F.when(r > 0, r).otherwise(0.0)).alias("gain"), F.sum(F.when(r < 0, -r).otherwise(0.0)).alias("loss"),
        F.count_if("is_trade").alias("n_trades"),
    )
    root = F.sqrt(F.lit(float(factor)))
    sharpe = F.when(F.col("dev") > 0, F.col("mean") / F.col("dev") * root).otherwise(0.0)
    sortino = F.when(F.col("down") > 0, F.col("mean") / F.col("down") * root).otherwise(sharpe)
    moved = F.col("moves") > 0

    def or_zero(c: Column) -> Column:
        return F.when(moved, c).otherwise(0.0)

    return one.select(
        *order.keys,
        or_zero(F.col("total")).alias("total_return"), or_zero(sharpe).alias("sharpe_ratio"),
        or_zero(sortino).alias("sortino_ratio"), or_zero(F.col("dd")).alias("max_drawdown"),
        or_zero(div(F.col("wins").cast("double"), F.col("moves").cast("double"))).alias("win_rate"),
        or_zero(F.when(F.col("loss") > 0, F.col("gain") / F.col("loss")).otherwise(float("inf"))).alias("profit_factor"),
        "n_trades",
    )


def aggregate_folds(per_fold: DataFrame) -> DataFrame:
    """Means, population deviation of the return, and trade total over folds."""
    mean = {
        "avg_total_return": "total_return", "avg_sharpe": "sharpe_ratio", "avg_max_drawdown": "max_drawdown",
        "avg_win_rate": "win_rate", "avg_directional_accuracy": "directional_accuracy", "avg_mse": "mse", "avg_r2": "r2",
    }
    aggs = [F.avg(c).alias(a) for a, c in mean.items() if c in per_fold.columns]
    return per_fold.agg(
        F.count(F.lit(1)).alias("n_splits"), F.stddev_pop("total_return").alias("std_total_return"),
        F.sum("n_trades").alias("total_trades"), *aggs,
    )


def regression_metrics(df: DataFrame, keys: tuple[str, ...] = (), actual: str = "y", predicted: str = "y_pred") -> DataFrame:
    """mse, rmse, mae and r2 over rows where both are numbers; r2 is 0 for a constant target."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    df = df.filter(y.isNotNull() & p.isNotNull() & ~F.isnan(y) & ~F.isnan(p))
    err = y - p
    n = F.count(F.lit(1)).cast("double")
    res, tot = F.sum(err * err), F.var_pop(y) * n
    return df.groupBy(*keys).agg(
        F.avg(err * err).alias("mse"), F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"),
        F.when(tot > 0, 1 - res / tot).otherwise(F.when(n > 0, 0.0)).alias("r2"),
    )


def _direction(x: Column, threshold: Column) -> Column:
    by_sign = F.signum(x).cast("int")
    by_size = F.when(x > threshold, 1).when(x < -threshold, -1).otherwise(0)
    return F.when(threshold == 0, by_sign).otherwise(by_size)


def directional_accuracy(
    df: DataFrame, keys: tuple[str, ...] = (), threshold: float | str | None = None,
    actual: str = "y", predicted: str = "y_pred",
) -> DataFrame:
    """Share of equal directions, overall and for up and down moves.

    `threshold` is None (sign), a number, or ``percentile``: the 33rd percentile of |actual|.
    """
    if threshold == "percentile":
        levels = exact_quantiles(df, F.abs(F.col(actual).cast("double")), {"_t": 0.33}, keys)
        if keys:
            df = join_small(df, levels, list(keys))
        else:
            df = df.withColumn("_one", F.lit(1)).join(F.broadcast(levels.withColumn("_one", F.lit(1))), "_one").drop("_one")
    else:
        df = df.withColumn("_t", F.lit(float(threshold or 0)))
    df = df.withColumns({
        "_a": _direction(F.col(actual), F.col("_t")), "_p": _direction(F.col(predicted), F.col("_t"))
    })
    a, p = F.col("_a"), F.col("_p")

    def share(hit: Column, base: Column) -> Column:
        return F.coalesce(div(F.count_if(hit).cast("double"), F.count_if(base).cast("double")), F.lit(0.0))

    return df.groupBy(*keys).agg(
        share(a == p, F.lit(True)).alias("directional_accuracy"),
        share((a > 0) & (p > 0), a > 0).alias("up_accuracy"),
        share((a < 0) & (p < 0), a < 0).alias("down_accuracy"),
        F.count_if(a > 0).alias("up_count"), F.count_if(a < 0).alias("down_count"),
        F.count_if(a == 0).alias("flat_count"), F.max("_t").alias("threshold_used"),
    )


def trading_metrics(
    df: DataFrame, order: Order = DEFAULT, cost_bps: float = 0.5, actual: str = "y", predicted: str = "y_pred",
    returns_unit: str = "fraction", factor: float = MINUTES,
) -> DataFrame:
    """Metrics of always holding the predicted sign; the first entry is charged.

    The cost is `cost_bps` in basis points; it is taken as a fraction of the return unless
    `returns_unit` is ``bps``.
    """
    plan = layout(df, order)
    cost = cost_bps / 10000 if returns_unit == "fraction" else cost_bps
    df = df.withColumn("_pos", F.signum(F.col(predicted)))

    def build(d, w):
        return d.withColumn("_change", F.abs(F.col("_pos") - F.lag("_pos", 1, 0.0).over(w)))

    df = over_rows(df, build, order, back=1, plan=plan)
    df = df.withColumn("_net", F.col(actual) * F.col("_pos") - F.col("_change") * F.lit(cost))
    df = running(df, {"_cum": ("sum", F.col("_net"))}, order, plan=plan)
    if not plan.single:
        df = cut_lineage(df.select(*order.keys, *order.columns, "_net", "_cum", "_change"))
    df = running(df, {"_peak": ("max", F.col("_cum"))}, order, plan=plan)
    r = F.col("_net")
    one = df.groupBy(*order.keys).agg(
        F.sum(r).alias("total"), F.avg(r).alias("mean"), F.stddev_pop(r).alias("dev"), F.count(r).alias("n"),
        F.max(F.col("_peak") - F.col("_cum")).alias("dd"), F.count_if(r > 0).alias("wins"), F.count_if(r < 0).alias("losses"),
        F.sum(F.when(r > 0, r).otherwise(0.0)).alias("gain"), F.sum(F.when(r < 0, -r).otherwise(0.0)).alias("loss"),
        F.sum("_change").alias("changes"),
    )
    decided = (F.col("wins") + F.col("losses")).cast("double")
    return one.select(
        *order.keys, F.col("total").alias("total_pnl_bps"),
        F.when((F.col("n") > 1) & (F.col("dev") > 0), F.col("mean") / F.col("dev") * F.sqrt(F.lit(float(factor)))).otherwise(0.0).alias("sharpe_ratio"),
        F.col("dd").alias("max_drawdown_bps"), F.coalesce(div(F.col("wins").cast("double"), decided), F.lit(0.0)).alias("win_rate"),
        F.when(F.col("loss") > 0, F.col("gain") / F.col("loss")).otherwise(float("inf")).alias("profit_factor"),
        F.floor(F.col("changes") / 2).cast("bigint").alias("num_trades"), F.col("mean").alias("avg_return_bps"),
    )


def with_equity(df: DataFrame, returns: str = "r", order: Order = DEFAULT, plan=None) -> DataFrame:
    """Compound growth since the first row, as `equity`; a return of -1 or less ends it at 0."""
    r = F.col(returns)
    plan = plan or layout(df, order)
    df = running(df, {
        "_log": ("sum", F.when(r > -1, F.log1p(r))), "_ruin": ("max", F.when(r <= -1, 1)),
    }, order, plan=plan)
    grown = F.exp(F.coalesce("_log", F.lit(0.0)))
    return df.withColumn("equity", F.when(F.col("_ruin").isNotNull(), 0.0).otherwise(grown)).drop("_log", "_ruin")


def compound_metrics(df: DataFrame, returns: str = "r", order: Order = DEFAULT, factor: float = HOURS) -> DataFrame:
    """Metrics of a return series that compounds."""
    plan = layout(df, order)
    df = with_equity(df.select(*order.keys, *order.columns, returns), returns, order, plan)
    if not plan.single:
        df = cut_lineage(df)
    df = running(df, {"_peak": ("max", F.col("equity"))}, order, plan=plan)
    r = F.col(returns)
    n = F.count(r).cast("double")
    one = df.groupBy(*order.keys).agg(
        F.max_by("equity", order.stamp()).alias("last"), F.avg(r).alias("mean_return"), F.stddev_pop(r).alias("std_return"),
        F.min(div(F.col("equity") - F.col("_peak"), F.col("_peak"))).alias("max_drawdown"),
        (F.count_if(r > 0) / n).alias("win_rate"), F.count(r).alias("n_trades"),
        F.sum(F.when(r > 0, r).otherwise(0.0)).alias("gain"), F.sum(F.when(r < 0, -r).otherwise(0.0)).alias("loss"),
    )
    sharpe = F.sqrt(F.lit(float(factor))) * F.col("mean_return") / F.col("std_return")
    return one.select(
        *order.keys, (F.col("last") - 1).alias("total_return"),
        F.when(F.col("std_return") > 0, sharpe).otherwise(0.0).alias("sharpe_ratio"), "max_drawdown", "win_rate",
        F.when(F.col("loss") > 0, F.col("gain") / F.col("loss")).otherwise(float("inf")).alias("profit_factor"),
        "n_trades", "mean_return", "std_return",
    )


def portfolio_returns(df: DataFrame, value: str = "portfolio_value", order: Order = DEFAULT) -> DataFrame:
    """Change per step (0 on the first row) and cumulative return of a portfolio value."""
    plan = layout(df, order)

    def build(d, w):
        before = F.lag(value).over(w)
        return d.withColumn("step_return", F.coalesce(div(F.col(value) - before, before), F.lit(0.0)))

    df = over_rows(df, build, order, back=1, plan=plan)
    df = with_equity(df, "step_return", order, plan)
    return df.withColumn("cumulative_return", F.col("equity") - 1).drop("equity")


def prediction_error(predicted: Column, current: Column) -> Column:
    return div(predicted - current, current)


def pinball_loss(df: DataFrame, quantiles: dict[str, float], actual: str = "y", keys: tuple[str, ...] = ()) -> DataFrame:
    """Mean quantile loss per predicted column and over all of them."""
    losses = {}
    for column, q in quantiles.items():
        e = F.col(actual) - F.col(column)
        losses[column] = F.greatest(e * F.lit(q), e * F.lit(q - 1))
    each = [F.avg(c).alias(f"loss_{name}") for name, c in losses.items()]
    out = df.groupBy(*keys).agg(*each)
    total = sum((F.col(f"loss_{name}") for name in losses), F.lit(0.0))
    return out.withColumn("loss", total / len(losses))


def pnl_curve(df: DataFrame, fold: str = "fold", order: Order = DEFAULT) -> DataFrame:
    """Profit curve over consecutive folds: each starts where the one before it ended."""
    keys = list(order.keys)
    per_fold = order.by(*keys, fold)
    df = row_index(df, per_fold, "_rn")
    totals = df.groupBy(*keys, fold).agg(F.sum("net_return").alias("_end"))
    whole = Order(tuple(keys), fold, (), order.block_rows, 1)
    totals = running(totals.withColumn(fold, F.col(fold).cast("bigint")), {"_offset": ("sum", F.col("_end"))}, whole, exclusive=True)
    df = join_small(df.withColumn(fold, F.col(fold).cast("bigint")), totals.drop("_end"), [*keys, fold])
    value = F.col("cumulative_pnl") + F.coalesce("_offset", F.lit(0.0))
    return df.select(*keys, fold, (F.col("_rn") - 1).alias("idx"), value.alias("cumulative_pnl"))
