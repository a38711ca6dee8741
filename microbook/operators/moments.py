"""Counts, means and co-moments of columns: one aggregate from which linear models are fitted and scored.

Blocks of rows are aggregated once and merged on the driver, so every training window of a search or a backtest is a sum over
its blocks. A block is one small row whatever its size; the number of blocks is the number of windows' bounds.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Moments:
    """Rows, means and sums of products of deviations; extremes of each column."""

    n: int
    mean: np.ndarray
    co: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def __add__(self, other: "Moments") -> "Moments":
        n = self.n + other.n
        if not self.n or not other.n:
            return self if self.n else other
        apart = other.mean - self.mean
        mean = self.mean + apart * (other.n / n)
        co = self.co + other.co + np.outer(apart, apart) * (self.n * other.n / n)
        return Moments(n, mean, co, np.minimum(self.low, other.low), np.maximum(self.high, other.high))

    def scaled(self, center: np.ndarray, scale: np.ndarray) -> "Moments":
        """Those of (column - center) / scale, for positive scales."""
        low, high = (self.low - center) / scale, (self.high - center) / scale
        return Moments(self.n, (self.mean - center) / scale, self.co / np.outer(scale, scale), low, high)

    def deviation(self) -> np.ndarray:
        """Sample deviation; 0 or undefined becomes 1."""
        if self.n < 2:
            return np.ones(len(self.mean))
        out = np.sqrt(np.diag(self.co) / (self.n - 1))
        return np.where(out > 0, out, 1.0)


def nothing(width: int) -> Moments:
    return Moments(0, np.zeros(width), np.zeros((width, width)), np.full(width, np.inf), np.full(width, -np.inf))


def total(parts: Iterable[Moments], width: int) -> Moments:
    return reduce(Moments.__add__, parts, nothing(width))


def block_moments(df: DataFrame, columns: list[str], block: str) -> DataFrame:
    """One row per block: n, and arrays of means, extremes and the upper triangle of co-moments.

    Rows with a null or NaN among `columns` are left out. The built-in covariance updates deviations, not raw products, so large
    means cost no digits; everything is combined map-side.
    """
    x = [F.col(c).cast("double") for c in columns]
    named = df.select(F.col(block).alias("block"), *[F.when(~F.isnan(c), c).alias(f"x{i}") for i, c in enumerate(x)]).dropna(subset=[f"x{i}" for i in range(len(x))])
    x = [F.col(f"x{i}") for i in range(len(columns))]
    upper = [F.covar_pop(x[i], x[j]) for i in range(len(x)) for j in range(i, len(x))]
    return named.groupBy("block").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.avg(c) for c in x]).alias("mean"), F.array(*upper).alias("co"),
        F.array(*[F.min(c) for c in x]).alias("low"), F.array(*[F.max(c) for c in x]).alias("high"))


def collected(df: DataFrame, columns: list[str], block: str, most: int = 10_000) -> dict[int, Moments]:
    """`block_moments` on the driver; `most` blocks at most."""
    rows = block_moments(df, columns, block).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"over {most} blocks")
    out, width = {}, len(columns)
    for r in rows:
        co = np.zeros((width, width))
        co[np.triu_indices(width)] = np.array(r["co"]) * r["n"]
        co = co + np.triu(co, 1).T
        out[r["block"]] = Moments(r["n"], np.array(r["mean"]), co, np.array(r["low"]), np.array(r["high"]))
    return out


@dataclass(frozen=True)
class LinearFit:
    """A linear model: a weight for each feature, in their order."""

    weights: np.ndarray
    intercept: float

    @property
    def coefficients(self) -> DenseVector:
        """The weights as the vector that Spark ML's models give."""
        return Vectors.dense(self.weights)

    def expression(self, values: list[Column]) -> Column:
        """The prediction as a column expression over the features' expressions."""
        return reduce(lambda a, b: a + b, [F.lit(float(w)) * v for w, v in zip(self.weights, values)], F.lit(float(self.intercept)))

    def squared_error(self, rows: Moments) -> float | None:
        """Mean squared error over rows known by their moments, the label last; None without rows."""
        if not rows.n:
            return None
        w = np.append(-self.weights, 1.0)
        return float(w @ rows.co @ w / rows.n + (w @ rows.mean - self.intercept) ** 2)


def solve(rows: Moments, first: float = 0.0, second: float = 0.0, tolerance: float = 1e-12, rounds: int = 100_000) -> LinearFit:
    """Minimise half the mean squared error + first·|w| + second/2·|w|², the label being the last column.

    Without `first` this is one linear system (least squares takes the shortest solution if features depend on each other); with
    it, coordinate descent on the matrix, whose cost does not depend on the number of rows. The intercept is not penalised.
    """
    if not rows.n:
        raise ValueError("no complete row to fit on")
    gram, aim = rows.co[:-1, :-1] / rows.n, rows.co[:-1, -1] / rows.n
    if not first:
        w = np.linalg.solve(gram + second * np.eye(len(aim)), aim) if second else np.linalg.lstsq(gram, aim, rcond=None)[0]
        return LinearFit(w, float(rows.mean[-1] - rows.mean[:-1] @ w))
    w, step = np.zeros(len(aim)), np.diag(gram) + second
    for _ in range(rounds):
        moved = 0.0
        for j in range(len(aim)):
            if not step[j]:
                continue
            pull = aim[j] - gram[j] @ w + gram[j, j] * w[j]
            now = np.sign(pull) * max(abs(pull) - first, 0.0) / step[j]
            moved = max(moved, abs(now - w[j]) * np.sqrt(gram[j, j]))
            w[j] = now
        if moved <= tolerance * np.sqrt(max(rows.co[-1, -1] / rows.n, 1e-300)):
            break
    return LinearFit(w, float(rows.mean[-1] - rows.mean[:-1] @ w))
