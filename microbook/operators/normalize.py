"""Scaling: fits are one aggregate each and return a manifest DataFrame (one row per feature).

Transforms read the manifest (its size is the number of columns) into literals of one projection,
which works on batch and streaming frames alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from microbook.functions.expr import clip
from microbook.functions.names import classify, scaling_of
from microbook.functions.quantiles import quantiles
from microbook.operators.features import backward_fill, forward_fill
from microbook.plans.ordered import DEFAULT, Order
from microbook.session import cut_lineage

MANIFEST = (
    "feature string, scaler string, mean double, std double, median double, iqr double, q25 double, "
    "q75 double, min_val double, max_val double, n_samples bigint, n_nulls bigint"
)
_COLUMNS = [part.split()[0] for part in MANIFEST.split(", ")]


def _as_manifest(df: DataFrame) -> DataFrame:
    types = dict(part.split() for part in MANIFEST.split(", "))
    return df.select(*[
        (F.col(c) if c in df.columns else F.lit(None)).cast(types[c]).alias(c) for c in _COLUMNS
    ])


def _moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean, deviation, extremes and counts of all columns in one aggregate, a row per column."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs.append(F.struct(
            F.lit(c).alias("feature"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
            F.min(x).alias("min_val"), F.max(x).alias("max_val"), F.count(x).alias("n_samples"),
            F.count_if(x.isNull()).alias("n_nulls"),
        ).alias(c))
    return df.agg(*aggs).select(F.inline(F.array(*[F.col(f"`{c}`") for c in columns])))


def fit_standard(df: DataFrame, columns: list[str], moments: DataFrame | None = None) -> DataFrame:
    """Mean and sample deviation; deviation 0 or undefined becomes 1, an empty column (0, 1)."""
    out = (moments or _moments(df, columns)).drop("min_val", "max_val").withColumn("scaler", F.lit("standard"))
    out = out.withColumn("mean", F.coalesce("mean", F.lit(0.0)))
    std = F.col("std")
    out = out.withColumn("std", F.when(std.isNull() | F.isnan(std) | (std == 0), 1.0).otherwise(std))
    return _as_manifest(out)


def fit_minmax(df: DataFrame, columns: list[str], moments: DataFrame | None = None) -> DataFrame:
    """Minimum and maximum; a constant gets a range of 1, an empty column (0, 1)."""
    out = (moments or _moments(df, columns)).drop("mean", "std").withColumn("scaler", F.lit("minmax"))
    lo, hi = F.coalesce("min_val", F.lit(0.0)), F.col("max_val")
    out = out.withColumn("max_val", F.when(hi.isNull() | (hi == F.col("min_val")), lo + 1).otherwise(hi))
    return _as_manifest(out.withColumn("min_val", lo))


def fit_robust(
    df: DataFrame, columns: list[str], log1p: bool = True, interpolation: str = "nearest", moments: DataFrame | None = None,
) -> DataFrame:
    """Quartiles and median of log1p(x); a zero range becomes 1. All columns take one read for counts and three for ranks.

    Quartiles take the nearest rank by default, the median is the middle of the ranks.
    """
    counts = (moments or _moments(df, columns)).select("feature", "n_samples", "n_nulls")
    kinds = {"q25": interpolation, "median": "linear", "q75": interpolation}
    values = {c: F.log1p(F.col(c).cast("double")) if log1p else F.col(c) for c in columns}
    quarts = quantiles(df, values, {"q25": 0.25, "median": 0.5, "q75": 0.75}, (), kinds)
    out = counts.join(quarts.drop("n").withColumnRenamed("column", "feature"), "feature", "left")
    out = out.withColumns({
        "q25": F.coalesce("q25", F.lit(0.0)), "median": F.coalesce("median", F.lit(0.0)),
        "q75": F.coalesce("q75", F.lit(1.0)),
    })
    iqr = F.col("q75") - F.col("q25")
    out = out.withColumn("iqr", F.when(iqr == 0, 1.0).otherwise(iqr)).withColumn("scaler", F.lit("robust"))
    return _as_manifest(out)


def fit(df: DataFrame, interpolation: str = "nearest", training: bool = True) -> DataFrame:
    """Fit every known column by its class, with one read for all moments; `df` must be the training range."""
    if not training:
        raise ValueError("fit only on training data")
    groups = {kind: names for kind, names in classify(df.columns).items() if kind in ("standard", "robust", "minmax") and names}
    if not groups:
        raise ValueError("no column to scale")
    moments = cut_lineage(_moments(df, [c for names in groups.values() for c in names]))  # a row per column
    parts = []
    for kind, names in groups.items():
        mine = moments.filter(F.col("feature").isin(names))
        if kind == "robust":
            parts.append(fit_robust(df, names, interpolation=interpolation, moments=mine))
        else:
            parts.append((fit_standard if kind == "standard" else fit_minmax)(df, names, mine))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _scaled(x: Column, row) -> Column:
    if row.scaler == "standard":
        return (x - F.lit(row.mean)) / F.lit(row.std)
    if row.scaler == "robust":
        return (F.log1p(x) - F.lit(row.median)) / F.lit(row.iqr)
    if row.scaler == "minmax":
        return (x - F.lit(row.min_val)) / F.lit((row.max_val - row.min_val) or 1.0)
    return x


def transform(df: DataFrame, manifest: DataFrame) -> DataFrame:
    """Scale the columns named in the manifest, pass the others through, in one projection."""
    rows = {r.feature: r for r in manifest.collect()}
    return df.select(*[
        _scaled(F.col(c), rows[c]).alias(c) if c in rows else F.col(c) for c in df.columns
    ])


def fit_first_then_transform(first: DataFrame, *rest: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Fit on the first frame, scale all of them with it."""
    manifest = fit(first)
    return manifest, [transform(d, manifest) for d in (first, *rest)]


# Tolerances of scaled columns.
TOLERANCE = {"mean": 0.1, "std": 0.2, "robust": 20.0, "minmax": (-0.01, 1.01)}
STRICT_SCRIPT = {"mean": 0.15, "std": 0.2, "robust": 25.0, "minmax": (-0.01, 1.01)}


def check_scaled(df: DataFrame, manifest: DataFrame, limits: dict = TOLERANCE) -> DataFrame:
    """Per scaled column: mean, deviation, extremes, and whether they lie within the limits."""
    kinds = {r.feature: r.scaler for r in manifest.select("feature", "scaler").collect()}
    columns = [c for c in df.columns if c in kinds]
    scaler = F.create_map(*[F.lit(v) for c in columns for v in (c, kinds[c])])
    out = _moments(df, columns).filter(F.col("n_samples") > 0).withColumn("scaler", scaler[F.col("feature")])
    low, high = limits["minmax"]
    return out.select(
        "feature", "scaler", "mean", "std", "min_val", "max_val",
        F.when(F.col("scaler") == "standard", F.abs("mean") <= limits["mean"])
        .when(F.col("scaler") == "minmax", (F.col("min_val") >= low) & (F.col("max_val") <= high))
        .otherwise(True).alias("valid"),
        F.when(F.col("scaler") == "standard", (F.abs("mean") > limits["mean"]) | (F.abs(F.col("std") - 1) > limits["std"]))
        .when(F.col("scaler") == "robust", (F.col("min_val") < -limits["robust"]) | (F.col("max_val") > limits["robust"]))
        .otherwise((F.col("min_val") < low) | (F.col("max_val") > high)).alias("warning"),
    )


def inverse_standard(df: DataFrame, manifest: DataFrame, columns: list[str]) -> DataFrame:
    """Undo a standard scaling."""
    rows = {r.feature: r for r in manifest.collect()}
    return df.withColumns({c: F.col(c) * F.lit(rows[c].std) + F.lit(rows[c].mean) for c in columns if c in rows})


# --- preprocessing for model inputs -----------------------------------------------------------

def fit_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean, deviation (0 or undefined becomes 1), minimum and maximum per column."""
    columns = [c for c in columns if c in df.columns]
    out = _moments(df, columns).withColumn("scaler", F.lit("stats"))
    std = F.col("std")
    return _as_manifest(out.withColumn("std", F.when(std.isNull() | F.isnan(std) | (std == 0), 1.0).otherwise(std)))


def by_feature(stats: DataFrame | dict) -> dict:
    """Fitted rows by feature, one for each column; a dict is passed on, so that several steps share one fit."""
    return stats if isinstance(stats, dict) else {r.feature: r for r in stats.collect()}


def replace_infinite(df: DataFrame, columns: list[str], value: float = 0.0) -> DataFrame:
    """±inf to a constant; NaN stays."""
    inf = float("inf")
    return df.withColumns({c: F.when(F.abs(F.col(c)) == inf, value).otherwise(F.col(c)) for c in columns})


def clip_outliers(df: DataFrame, stats: DataFrame | dict, columns: list[str], n_std: float = 5.0) -> DataFrame:
    """Hold columns within mean ± n_std deviations of the fitted statistics."""
    rows = by_feature(stats)
    return df.withColumns({
        c: clip(F.col(c), F.lit(rows[c].mean - n_std * rows[c].std), F.lit(rows[c].mean + n_std * rows[c].std))
        for c in columns if c in rows
    })


def apply_zscore(df: DataFrame, stats: DataFrame | dict, columns: list[str]) -> DataFrame:
    rows = by_feature(stats)
    return df.withColumns({c: (F.col(c) - F.lit(rows[c].mean)) / F.lit(rows[c].std) for c in columns if c in rows})


def apply_minmax(df: DataFrame, stats: DataFrame | dict, columns: list[str], low: float = 0.0, high: float = 1.0) -> DataFrame:
    rows = by_feature(stats)
    return df.withColumns({
        c: (F.col(c) - F.lit(rows[c].min_val)) / F.lit((rows[c].max_val - rows[c].min_val) or 1.0) * (high - low) + low
        for c in columns if c in rows
    })


def preprocess(
    df: DataFrame, stats: DataFrame | dict, columns: list[str], normalize: str | None = "zscore",
    clip_std: float | None = 5.0, fill: str = "forward", order: Order = DEFAULT,
) -> DataFrame:
    """Fill nulls, replace infinities, clip and scale with statistics fitted before.

    `fill` is forward (then backward, then 0), zero or drop. No global sort: order is a property of
    the windows, not of the files. With any other `fill`, nulls stay.
    """
    columns, stats = [c for c in columns if c in df.columns], by_feature(stats)
    if fill == "forward":
        df = backward_fill(forward_fill(df, columns, order), columns, order).fillna(0.0, columns)
    elif fill == "zero":
        df = df.fillna(0.0, columns)
    elif fill == "drop":
        df = df.dropna(subset=columns)
    df = replace_infinite(df, columns)
    if clip_std is not None:
        df = clip_outliers(df, stats, columns, clip_std)
    if normalize == "zscore":
        return apply_zscore(df, stats, columns)
    return apply_minmax(df, stats, columns) if normalize == "minmax" else df


def classification(columns: list[str]) -> list[tuple[str, str]]:
    """(column, scaling method) in input order."""
    return [(c, scaling_of(c)) for c in columns]
