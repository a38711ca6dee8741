"""Linear models from co-moments, boosted trees with Spark ML, and walk-forward backtests over them."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from microbook.operators import backtest, normalize
from microbook.operators.features import forward_fill
from microbook.operators.moments import LinearFit, Moments, collected, solve, total
from microbook.operators.splits import block_roles, walk_forward_blocks
from microbook.plans.ordered import DEFAULT, Order
from microbook.session import cut_lineage

# Default penalties and search grids.
DEFAULTS = {
    "ridge": {"alpha": 1.0},
    "lasso": {"alpha": 0.01},
    "elasticnet": {"alpha": 0.01, "l1_ratio": 0.5},
    "linear": {},
}
GRIDS = {
    "ridge": [{"alpha": a} for a in (0.001, 0.01, 0.1, 1.0, 10.0, 100.0)],
    "lasso": [{"alpha": a} for a in (0.0001, 0.001, 0.01, 0.1, 1.0)],
    "elasticnet": [{"alpha": a, "l1_ratio": r} for a in (0.001, 0.01, 0.1) for r in (0.2, 0.5, 0.8)],
    "linear": [{}],
}
BOOST = {"maxDepth": 6, "stepSize": 0.1, "maxIter": 500, "subsamplingRate": 0.8, "seed": 42}


def assemble(df: DataFrame, features: list[str], invalid: str = "skip") -> DataFrame:
    """Add the vector of the features; rows with a null or NaN feature are left out, or kept with ``invalid="keep"``."""
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid=invalid).transform(df)


def fit_moments(rows: Moments, kind: str = "ridge", params: dict | None = None) -> LinearFit:
    """Fit ridge, lasso, elastic net or least squares, with penalties as usually stated, on moments with the label last.

    Ridge minimises the squared error sum plus alpha·|w|²; lasso and elastic net minimise half the mean squared error plus alpha
    times the mixed penalty. Features are not standardised.
    """
    if kind not in DEFAULTS:
        raise ValueError(f"unknown model {kind!r}")
    p = {**DEFAULTS[kind], **(params or {})}
    if kind == "linear":
        return solve(rows)
    if kind == "ridge":
        return solve(rows, 0.0, p["alpha"] / max(rows.n, 1))
    ratio = 1.0 if kind == "lasso" else p["l1_ratio"]
    return solve(rows, p["alpha"] * ratio, p["alpha"] * (1 - ratio))


def fit_linear(df: DataFrame, features: list[str], label: str = "target", kind: str = "ridge", params: dict | None = None) -> LinearFit:
    """`fit_moments` on the complete rows of `df`: one aggregate, whatever the model."""
    if kind not in DEFAULTS:
        raise ValueError(f"unknown model {kind!r}")
    rows = collected(df.withColumn("_all", F.lit(0)), [*features, label], "_all")
    return fit_moments(total(rows.values(), len(features) + 1), kind, params)


def predict(model, df: DataFrame, features: list[str], name: str = "y_pred") -> DataFrame:
    """Add the prediction to every row; it is null where a feature is null or NaN."""
    values = [F.col(f).cast("double") for f in features]
    whole = reduce(lambda a, b: a & b, [v.isNotNull() & ~F.isnan(v) for v in values])
    if isinstance(model, LinearFit):
        return df.withColumn(name, F.when(whole, model.expression(values)))
    out = model.transform(assemble(df, features, "keep"))
    return out.withColumn("prediction", F.when(whole, F.col("prediction"))).drop("features").withColumnRenamed("prediction", name)


def fit_boosted(df: DataFrame, features: list[str], label: str = "target", validation: str | None = None, params: dict | None = None):
    """Gradient-boosted trees; with `validation` (a boolean column), boosting stops when it stops helping."""
    rows = assemble(df, features).withColumn("label", F.col(label).cast("double")).filter("label is not null")
    model = GBTRegressor(**{**BOOST, **(params or {})})
    if validation:
        model = model.setValidationIndicatorCol(validation)
    return model.fit(rows)


def importance(spark, model, features: list[str], top: int | None = None) -> DataFrame:
    """Features by |coefficient| or by the trees' gain, largest first."""
    weights = model.weights if isinstance(model, LinearFit) else model.featureImportances.toArray()
    rows = [(f, abs(float(w))) for f, w in zip(features, weights)]
    out = spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
    return out.limit(top) if top else out


def fold_moments(roles: DataFrame, columns: list[str], n_splits: int) -> list[tuple[Moments, Moments]]:
    """(training, test) moments of every split, from one read: rows with equal roles are one block."""
    blocks = collected(roles, columns, "roles")

    def of(bit: int) -> Moments:
        return total([m for mask, m in blocks.items() if mask >> bit & 1], len(columns))

    return [(of(2 * i), of(2 * i + 1)) for i in range(n_splits)]


def search_linear(
    df: DataFrame, features: list[str], label: str = "target", kind: str | tuple[str, ...] = "ridge", n_splits: int = 5,
    order: Order = DEFAULT,
) -> DataFrame:
    """Mean squared error of every grid point over expanding folds, best first in each kind of model.

    The data is read once: every fold is fitted and scored from the moments of its blocks.
    """
    roles = block_roles(df.filter(F.col(label).isNotNull()), n_splits, order=order)
    folds = fold_moments(roles, [*features, label], n_splits)
    out = []
    for one in (kind,) if isinstance(kind, str) else kind:
        scored = []
        for params in GRIDS[one]:
            errors = [fit_moments(train, one, params).squared_error(test) for train, test in folds if train.n and test.n]
            scored.append((one, str(params), sum(errors) / len(errors) if errors else None))
        out += sorted(scored, key=lambda r: (r[2] is None, r[2] or 0.0, r[1]))
    return df.sparkSession.createDataFrame(out, "model string, params string, mse double")


def compare_linear(train: DataFrame, test: DataFrame, features: list[str], label: str = "target", kinds: tuple[str, ...] = tuple(DEFAULTS)) -> DataFrame:
    """Regression metrics and directional accuracy per kind of linear model: one read to fit, one pass to score all of them."""
    rows = total(collected(train.withColumn("_all", F.lit(0)), [*features, label], "_all").values(), len(features) + 1)
    for kind in kinds:
        test = predict(fit_moments(rows, kind), test, features, f"_{kind}")
    each = F.explode(F.array(*[F.struct(F.lit(kind).alias("model"), F.col(f"_{kind}").alias("y_pred")) for kind in kinds]))
    scored = test.select(F.col(label).alias("y"), each.alias("s")).select("y", "s.*")
    reg = backtest.regression_metrics(scored, ("model",))
    hits = backtest.directional_accuracy(scored, ("model",)).select("model", "directional_accuracy")
    return reg.join(F.broadcast(hits), "model")  # a row per kind


Fit = Callable[[DataFrame, list[str], str], object]


def walk_forward_backtest(
    df: DataFrame, features: list[str], label: str = "target", fit: Fit | str = "ridge",
    strategy: backtest.Strategy = backtest.threshold_signal, n_splits: int = 5, train_window: int | None = None,
    test_window: int | None = None, cost: float = 0.1, order: Order = DEFAULT,
    scale: str | None = "zscore", clip_std: float | None = 5.0, params: dict | None = None,
) -> DataFrame:
    """Train on the past, score the next block, for every split; returns scored rows with profit and loss.

    Null features take the last value before them, or 0. Infinities become 0, then features are clipped and scaled with
    statistics of the split's own training range. `fit` names a linear model, which needs two reads for all splits together, or
    is a function that is called once a split. Follow with `fold_results`.
    """
    known = forward_fill(df.filter(F.col(label).isNotNull()), features, order).fillna(0.0, features)
    windows = (n_splits, train_window, test_window, order)
    if isinstance(fit, str):
        out = _walk_linear(normalize.replace_infinite(known, features), features, label, fit, params, windows, scale, clip_std)
    else:
        out = _walk_each(known, features, label, fit, windows, scale, clip_std)
    return backtest.pnl(out.withColumn("signal", strategy(F.col("y_pred"))), "signal", label, cost, order.by(*order.keys, "fold"))


def _walk_each(known: DataFrame, features: list[str], label: str, fit: Fit, windows: tuple, scale: str | None, clip_std: float | None) -> DataFrame:
    """One preparation, fit and scoring for each split."""
    folds, order = cut_lineage(walk_forward_blocks(known, *windows)), windows[-1]
    scored = []
    for fold in range(windows[0]):
        part = normalize.replace_infinite(folds.filter(F.col("fold") == fold), features)
        stats = normalize.by_feature(normalize.fit_stats(part.filter(F.col("split") == "train"), features))
        part = normalize.preprocess(part, stats, features, scale, clip_std, "none", order)
        model = fit(part.filter(F.col("split") == "train"), features, label)
        scored.append(predict(model, part.filter(F.col("split") == "test"), features))
    return reduce(DataFrame.unionByName, scored)


def _walk_linear(
    known: DataFrame, features: list[str], label: str, kind: str, params: dict | None, windows: tuple, scale: str | None,
    clip_std: float | None,
) -> DataFrame:
    """All splits from moments: one read gives every split's statistics, one more the moments of its clipped training rows
    (scaling alone needs no second read: it is folded into the matrix), and the test rows are scored in a single pass."""
    n_splits, width = windows[0], len(features)
    roles = cut_lineage(block_roles(known, *windows))
    raw = [train for train, _ in fold_moments(roles, [*features, label], n_splits)]
    folds = [i for i in range(n_splits) if raw[i].n]
    center, size, low, high = {}, {}, {}, {}
    for i in folds:
        mean, dev = raw[i].mean[:width], raw[i].deviation()[:width]
        bound = clip_std * dev if clip_std is not None else [float("inf")] * width
        low[i], high[i] = mean - bound, mean + bound
        if scale == "minmax":
            span = raw[i].high[:width] - raw[i].low[:width]
            center[i], size[i] = raw[i].low[:width], [float(s) or 1.0 for s in span]
        else:
            center[i], size[i] = (mean, dev) if scale == "zscore" else ([0.0] * width, [1.0] * width)

    def of(values: dict, j: int) -> Column:
        """The value of feature j for the row's split."""
        return F.array(*[F.lit(float(values[i][j])) if i in values else F.lit(0.0) for i in range(n_splits)])[F.col("fold")]

    def prepared(bit: int) -> tuple[DataFrame, list[Column]]:
        rows = roles.withColumn("fold", F.explode(F.array_compact(F.array(*[F.when(F.col("roles").bitwiseAND(1 << 2 * i + bit) != 0, F.lit(i)) for i in folds]))))
        values = []
        for j, f in enumerate(features):
            x = F.col(f).cast("double")
            if clip_std is not None:
                x = F.least(F.greatest(x, of(low, j)), of(high, j))
            values.append((x - of(center, j)) / of(size, j))
        return rows, values

    if not folds:
        return roles.where("false").withColumns({"fold": F.lit(0), "split": F.lit("test"), "y_pred": F.lit(0.0)}).drop("roles")
    if clip_std is None:
        trained = {i: raw[i].scaled(np.append(center[i], 0.0), np.append(size[i], 1.0)) for i in folds}
    else:
        rows, values = prepared(0)
        rows = rows.select("fold", *[v.alias(f"x{j}") for j, v in enumerate(values)], F.col(label).alias("y"))
        trained = collected(rows, [*[f"x{j}" for j in range(width)], "y"], "fold")
    models = {i: fit_moments(trained[i], kind, params) for i in folds}
    weights = {i: [*m.weights, m.intercept] for i, m in models.items()}
    rows, values = prepared(1)
    score = reduce(lambda a, b: a + b, [of(weights, j) * v for j, v in enumerate(values)], of(weights, width))
    scored = rows.withColumn("y_pred", score).withColumns(dict(zip(features, values))).withColumn("split", F.lit("test"))
    return scored.drop("roles")


def fold_results(scored: DataFrame, label: str = "target", order: Order = DEFAULT) -> DataFrame:
    """Performance, model metrics and directional accuracy per key and fold."""
    keys = (*order.keys, "fold")
    perf = backtest.performance(scored, order.by(*keys))
    reg = backtest.regression_metrics(scored, keys, label)
    hits = backtest.directional_accuracy(scored, keys, None, label).select(*keys, "directional_accuracy")
    return perf.join(reg, list(keys)).join(hits, list(keys))
