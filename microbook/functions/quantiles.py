"""Exact quantiles by radix histograms.

The built-in ``percentile`` keeps a map of every distinct value in one buffer, and sketches ship theirs to one task. Here a double
is an unsigned 64-bit number of the same order. The first read counts its highest bits for all columns at once; the digit that
holds a wanted rank is known then, and the next read counts the following bits of the values that begin with it. Counts are
combined in each batch, in each task and by the shuffle; at most 65,536 of them belong to one key, column and rank in the first
read. The third read counts what is left value by value: of spread-out values about one in 65,536.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from microbook.plans.ordered import counted
from microbook.session import cut_lineage

DIGITS = (16, 12, 36)  # bits counted in each read


def sortable(values: np.ndarray) -> np.ndarray:
    """Doubles as unsigned numbers of the same order; -0 is 0, NaN the largest."""
    x = np.where(np.isnan(values), np.nan, values + 0.0)
    bits = x.view(np.int64)
    return np.where(bits < 0, ~bits, bits ^ np.int64(-(2**63))).view(np.uint64)


def _codes(columns: list[pa.Array], rows: int) -> np.ndarray:
    """A number for each combination of the key columns in a batch."""
    code = np.zeros(rows, np.int64)
    for column in columns:
        _, code = np.unique(code * (rows + 1) + column.dictionary_encode("encode").indices.to_numpy(), return_inverse=True)
    return code


def _histogram(rows: DataFrame, keys: list[str], columns: int, picks: list | None, level: int) -> DataFrame:
    """keys, c (column), s (rank), digit, n, value (one of them) of the values that begin with the digits found so far.

    `rows` has the keys, the value columns v0.. and, with keys, the digits found so far as p<c>_<s>; without keys they are in
    `picks`. The first read has no ranks: s is -1.
    """
    fixed = [rows.schema[k] for k in keys]
    schema = T.StructType([*fixed, T.StructField("c", T.IntegerType()), T.StructField("s", T.IntegerType()),
                           T.StructField("digit", T.LongType()), T.StructField("n", T.LongType()), T.StructField("value", T.DoubleType())])
    names, known, bits = rows.columns, sum(DIGITS[:level]), DIGITS[level]
    left = np.uint64(64 - known - bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = {name: batch.column(i) for i, name in enumerate(names)}
            code = _codes([at[k] for k in keys], batch.num_rows)
            out: list[tuple] = []
            for c in range(columns):
                there = at[f"v{c}"].is_valid().to_numpy(zero_copy_only=False)
                value = at[f"v{c}"].fill_null(0.0).to_numpy()
                number = sortable(value)
                digit = ((number >> left) & np.uint64((1 << bits) - 1)).astype(np.int64)
                slots = [(-1, there)]
                if level:
                    prefix = (number >> np.uint64(64 - known)).astype(np.int64)
                    wanted = {s: p for i, s, p in picks if i == c} if picks is not None else {
                        int(name.split("_")[1]): at[name].fill_null(-1).to_numpy() for name in names if name.startswith(f"p{c}_")}
                    slots = [(s, there & (prefix == p)) for s, p in wanted.items()]
                for s, mine in slots:
                    where = np.flatnonzero(mine)
                    if not where.size:
                        continue
                    # a batch has far fewer than 2^26 keys
                    _, first, n = np.unique(code[where] << np.int64(bits) | digit[where], return_index=True, return_counts=True)
                    first = where[first]
                    out.append((first, np.full(len(first), c), np.full(len(first), s), digit[first], n, value[first]))
            if out:
                index, *rest = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [*[at[k].take(pa.array(index)) for k in keys], *[pa.array(x.astype(t)) for x, t in zip(rest, (np.int32, np.int32, np.int64, np.int64, np.float64))]],
                    [f.name for f in schema])

    return rows.mapInArrow(run, schema).groupBy(*keys, "c", "s", "digit").agg(F.sum("n").alias("n"), F.max("value").alias("value"))


def quantiles(
    df: DataFrame, columns: dict[str, Column | str], probs: dict[str, float], keys: tuple[str, ...] = (),
    interpolation: str | dict[str, str] = "linear",
) -> DataFrame:
    """One row per key and column: keys, `column`, n (its values), and a column for each entry of `probs`.

    `interpolation` is ``linear`` (between the two neighbouring ranks) or ``nearest``, for all or by name. The input is read three
    times for all columns and ranks together: give windows as a written table. Nulls are left out; a column without values has no
    row. Without keys, what is collected is one number per column and rank.
    """
    k, names = list(keys), list(columns)
    kind = interpolation if isinstance(interpolation, dict) else dict.fromkeys(probs, interpolation)
    values = [(F.col(c) if isinstance(c, str) else c).cast("double").alias(f"v{i}") for i, c in enumerate(columns.values())]
    rows = df.select(*k, *values)
    by = Window.partitionBy(*k, "c", "s")
    upto = by.orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)

    # ranks: two neighbours for each probability
    place = {name: F.lit(float(p)) * (F.col("total") - 1).cast("double") for name, p in probs.items()}
    ranks = []
    for name in probs:
        low, high = (F.floor(place[name] + 0.5),) * 2 if kind[name] == "nearest" else (F.floor(place[name]), F.ceil(place[name]))
        ranks += [low.cast("bigint"), high.cast("bigint")]
    found = _histogram(rows, k, len(names), None, 0)
    found = found.withColumns({"total": F.sum("n").over(by), "upto": F.sum("n").over(upto)}).drop("s")
    found = found.withColumn("r", F.explode(F.array(*[F.struct(F.lit(s).alias("s"), r.alias("rank")) for s, r in enumerate(ranks)]))).select("*", "r.*")
    inside = (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n"))
    picked = found.where(inside).select(*k, "c", "s", "total", F.col("digit").alias("prefix"), (F.col("rank") - F.col("upto") + F.col("n")).alias("rest"))
    for level in range(1, len(DIGITS)):
        picked = cut_lineage(picked.select(*k, "c", "s", "total", "prefix", "rest"))
        if k:
            wide = picked.groupBy(*k).agg(*[
                F.max(F.when((F.col("c") == c) & (F.col("s") == s), F.col("prefix"))).alias(f"p{c}_{s}") for c in range(len(names)) for s in range(len(ranks))])
            counts = _histogram(rows.join(counted(wide), k), k, len(names), None, level)
        else:
            known = [(r["c"], r["s"], r["prefix"]) for r in picked.collect()]  # columns times ranks
            counts = _histogram(rows, k, len(names), known, level)
        counts = counts.withColumn("upto", F.sum("n").over(upto))
        both = counts.join(F.broadcast(picked) if not k else counted(picked), [*k, "c", "s"])
        inside = (F.col("rest") < F.col("upto")) & (F.col("rest") >= F.col("upto") - F.col("n"))
        picked = both.where(inside).select(
            *k, "c", "s", "total", (F.shiftleft("prefix", DIGITS[level]) + F.col("digit")).alias("prefix"),
            (F.col("rest") - F.col("upto") + F.col("n")).alias("rest"), (F.col("value") + 0.0).alias("value"))
    table = picked.groupBy(*k, "c", F.col("total").alias("n")).agg(*[
        F.max(F.when(F.col("s") == s, F.col("value"))).alias(f"x{s}") for s in range(len(ranks))])
    total = F.col("n")
    out = []
    for i, (name, p) in enumerate(probs.items()):
        at, low, high = F.lit(float(p)) * (total - 1).cast("double"), F.col(f"x{2 * i}"), F.col(f"x{2 * i + 1}")
        out.append((low + (at - F.floor(at)) * (high - low) if kind[name] == "linear" else low).alias(name))
    named = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("c") + 1)
    return table.select(*k, named.alias("column"), "n", *out)


def exact_quantiles(
    df: DataFrame, value: Column | str, probs: dict[str, float], keys: tuple[str, ...] = (), interpolation: str | dict[str, str] = "linear",
) -> DataFrame:
    """`quantiles` of one value: one row per key with a column per entry of `probs`; no row without values."""
    return quantiles(df, {"x": value}, probs, keys, interpolation).drop("column", "n")
