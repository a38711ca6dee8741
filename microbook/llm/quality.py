"""Document quality by Bradley-Terry ranking of preference pairs.

A labelled good document is preferred to a labelled bad one; the chance of that is the logistic function of the difference of
their scores, which are linear in the features of the whole text. The threshold is the quantile of the training scores below
which lies the share of bad documents.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from microbook.functions.quantiles import exact_quantiles
from microbook.llm.common import columns, whole
from microbook.session import BROADCAST_ROWS, cut_lineage

GROUP = 2048  # distinct documents of the larger class that are paired together
OPPONENTS = 4  # pairs per document of the larger class
CUT = 0.3  # the score at the threshold
PENALTY = 1e-3

NAMES = ("words", "symbols", "bangs", "bars", "capitals", "repeats", "distinct", "pairs", "letters", "short", "stops", "commas",
         "digits", "same_lines", "lines")
XS = [f"x{i}" for i in range(len(NAMES))]


def features(text: str) -> list[float]:
    """Ratios of one whole text, most as square roots so that small shares show. An empty text gives zeros."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(NAMES)
    lines = [x for x in text.split("\n") if x]
    root = math.sqrt
    symbols = sum(map(text.count, "#*$%&<>~^={}[]@\\"))
    return [
        math.log1p(n), min(2.0, root(symbols / n)), min(2.0, root(text.count("!") / n)), min(2.0, root(text.count("|") / n)),
        root(sum(map(str.isupper, words)) / n), root(sum(map(operator.eq, words, words[1:])) / n), len(set(words)) / n,
        len(set(zip(words, words[1:]))) / n, min(20, sum(map(len, words)) / n) / 10, sum([len(w) < 4 for w in words]) / n,
        min(1.0, text.count(".") / n), min(1.0, text.count(",") / n), min(2.0, root(sum(map(text.count, "0123456789")) / n)),
        root(1 - len(set(lines)) / max(1, len(lines))), min(1.0, len(lines) / n),
    ]


@dataclass(frozen=True)
class Ranking:
    """A fitted score: weights of standardised features, and the raw score at the threshold."""

    mean: tuple[float, ...]
    spread: tuple[float, ...]
    weights: tuple[float, ...]
    threshold: float

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = ((x - np.array(self.mean)) / np.array(self.spread)) @ np.array(self.weights)
        return 1 / (1 + np.exp(-np.clip(raw - self.threshold + math.log(CUT / (1 - CUT)), -500, 500)))


def neutral() -> Ranking:
    """The score of no knowledge: a half for every text."""
    n = len(NAMES)
    return Ranking((0.0,) * n, (1.0,) * n, (0.0,) * n, math.log(CUT / (1 - CUT)))


def fit_pairs(better: np.ndarray, worse: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Weights that maximise the likelihood that row i of `better` beats row i of `worse`: Newton steps on the logistic loss."""
    d = better - worse
    w = np.zeros(d.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(np.clip(d @ w, -500, 500)))
        gradient = -(d.T @ p) / len(d) + PENALTY * w
        curve = (d * (p * (1 - p))[:, None]).T @ d / len(d) + PENALTY * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        step *= min(1.0, 4 / max(1e-12, float(np.abs(step).max())))
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    return w


def rank(x: np.ndarray, good: np.ndarray) -> Ranking:
    """Fit on features and labels. One class alone gives no pairs and the neutral score."""
    if not good.any() or good.all():
        return neutral()
    mean, spread = x.mean(0), x.std(0)
    spread[spread < 1e-9] = 1.0
    z = (x - mean) / spread
    up, down = z[good], z[~good]
    n = OPPONENTS * max(len(up), len(down))
    # each document of either class in turn, against opponents a fixed stride apart
    i = np.arange(n)
    w = fit_pairs(up[i % len(up)], down[(i // max(len(up), len(down)) * 7919 + i * 31) % len(down)])
    scores = np.sort(z @ w)
    bad = int((~good).sum())
    return Ranking(tuple(mean), tuple(spread), tuple(w), float((scores[bad - 1] + scores[bad]) / 2))


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; null ids give null."""
    return F.crc32(doc_id.cast("string")) % 5


def sampled(labels: DataFrame, sample: int) -> DataFrame:
    """doc_id and good (1 or 0) of at most `sample` labels outside the held-out fold, chosen by a hash of their id.

    Up to `sample` labels all are taken. Of more, those whose hash is in the first part of its range that holds no more than
    `sample`, found by counts in 4,096 steps; nothing is sorted. An id with more labels than `sample` ends that part before it.
    """
    known = columns(labels, doc_id="doc_id", good="quality").where(fold(F.col("doc_id")) != 0).where("good is not null")
    n = known.count()
    if n <= sample:
        return known
    reach = min(1.0, 4 * sample / n)
    step = F.floor(F.shiftrightunsigned(F.xxhash64("doc_id"), 12) / F.lit(float(1 << 52)) / F.lit(reach) * 4096)
    near = known.withColumn("_step", step).where("_step < 4096")
    cut, total = 0, 0
    for row in sorted(near.groupBy("_step").count().collect()):
        total += row["count"]
        if total > sample:
            break
        cut = row["_step"] + 1
    return near.where(F.col("_step") < cut).drop("_step")


def nodes(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """good, x0.. and n: the distinct features of all labelled documents outside the held-out fold, with their number of labels.

    Null labels and labels without a document do not count. Texts are not shuffled.
    """
    known = columns(labels, doc_id="doc_id", good="quality").where(fold(F.col("doc_id")) != 0).where("good is not null")
    known = cut_lineage(known.select("doc_id", (F.col("good") == 1).alias("good")))
    rows = columns(docs, doc_id="doc_id", text="text").where(fold(F.col("doc_id")) != 0)
    few = known.count() <= BROADCAST_ROWS
    if few:
        rows = rows.join(F.broadcast(known), "doc_id")
    kept = ["good"] if few else ["doc_id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array([features(t or "") for t in batch["text"]]).reshape(len(batch), len(NAMES))
            yield pd.concat([batch[kept].reset_index(drop=True), pd.DataFrame(x, columns=XS)], axis=1)

    fixed = ", ".join(f"{k} {t}" for k, t in rows.dtypes if k in kept)
    found = rows.select(*kept, "text").mapInPandas(run, f"{fixed}, " + ", ".join(f"{x} double" for x in XS))
    if not few:
        found = found.join(known, "doc_id")
    return cut_lineage(found.groupBy("good", *XS).agg(F.count(F.lit(1)).alias("n")))


def paired(found: DataFrame, mean: np.ndarray, spread: np.ndarray, size: int = GROUP) -> DataFrame:
    """Matrices of pairs, a row each: standardised features of the better one less those of the worse one, and the pair's weight.

    Both classes are dealt into groups by a hash. In a group each document of the larger class meets `OPPONENTS` of the other, and
    each of that is met. Of a small class each document is in several groups, so that some 32 are in each, or all. A pair weighs the
    product of its copies.
    """
    sizes = {r["good"]: r["count"] for r in found.groupBy("good").count().collect()}
    groups = -(-max(sizes.values()) // size)
    times = {good: min(groups, -(-32 * groups // n)) for good, n in sizes.items()}
    at = F.pmod(F.xxhash64(*XS), F.lit(groups))
    places = F.when(F.col("good"), F.sequence(F.lit(0), F.lit(times[True] - 1))).otherwise(F.sequence(F.lit(0), F.lit(times[False] - 1)))
    stride = F.when(F.col("good"), groups // times[True]).otherwise(groups // times[False])
    dealt = found.select("good", *XS, "n", F.explode(F.transform(places, lambda k: F.pmod(at + k * stride, F.lit(groups)))).alias("g"))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values([*XS])  # the same sums on any partitioning
        z, n, good = (part[XS].to_numpy() - mean) / spread, part["n"].to_numpy(float), part["good"].to_numpy(bool)
        if not good.any() or good.all():
            return pd.DataFrame({"d": []}, dtype=object)
        up, down = np.flatnonzero(good), np.flatnonzero(~good)
        most = max(len(up), len(down))
        i = np.arange(OPPONENTS * most)
        a, b = up[i % len(up)], down[(i + i // most) % len(down)]
        return pd.DataFrame({"d": [np.column_stack([z[a] - z[b], n[a] * n[b]]).tobytes()]})

    return cut_lineage(dealt.groupBy("g").applyInPandas(run, "d binary"))


def fit_all(pairs: DataFrame, width: int, rounds: int = 60) -> np.ndarray:
    """`fit_pairs` on all matrices of pairs: a round is one read, of which a gradient and a curvature a matrix come back."""
    w = np.zeros(width)
    for _ in range(rounds):
        def run(batches: Iterator[pd.DataFrame], w: np.ndarray = w) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = []
                for blob in batch["d"]:
                    m = np.frombuffer(blob).reshape(-1, width + 1)
                    d, n = m[:, :-1], m[:, -1]
                    p = 1 / (1 + np.exp(np.clip(d @ w, -500, 500)))
                    out.append([n.sum(), *(d.T @ (p * n)), *((d * (p * (1 - p) * n)[:, None]).T @ d).ravel()])
                yield pd.DataFrame({"v": out})

        parts = [r["v"] for r in pairs.mapInPandas(run, "v array<double>").collect()]
        if not parts:
            return w
        total = np.array([math.fsum(v) for v in zip(*parts)])  # exact, so in any order
        gradient = -total[1:width + 1] / total[0] + PENALTY * w
        step = np.linalg.solve(total[width + 1:].reshape(width, width) / total[0] + PENALTY * np.eye(width), gradient)
        step *= min(1.0, 4 / max(1e-12, float(np.abs(step).max())))
        w = w - step
        if np.abs(step).max() < 1e-7:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame) -> Ranking:
    """Fit on all labelled documents outside the held-out fold: means, pairs, weights and threshold are aggregates over them."""
    found = nodes(docs, labels)
    exact = [F.sum(F.col(x).cast("decimal(28,18)") * F.col("n")).alias(x) for x in XS]
    squares = [F.sum((F.col(x) * F.col(x)).cast("decimal(28,18)") * F.col("n")).alias(f"{x}s") for x in XS]
    one = found.agg(F.sum("n").alias("n"), F.sum(F.when(~F.col("good"), F.col("n"))).alias("bad"), *exact, *squares).first()
    total, bad = one["n"] or 0, one["bad"] or 0
    if not bad or bad == total:
        return neutral()
    mean = np.array([float(one[x] / total) for x in XS])
    spread = np.array([math.sqrt(max(0.0, float(one[f"{x}s"] / total - (one[x] / total) ** 2))) for x in XS])
    spread[spread < 1e-8] = 1.0
    w = fit_all(paired(found, mean, spread), len(XS))
    raw = reduce(operator.add, [(F.col(x) - float(m)) / float(s) * float(v) for x, m, s, v in zip(XS, mean, spread, w)])
    scores = cut_lineage(found.select(raw.alias("raw"), F.explode(F.sequence(F.lit(1).cast("bigint"), "n"))).select("raw"))
    cut = exact_quantiles(scores, "raw", {"below": (bad - 1) / (total - 1), "above": bad / (total - 1)}, interpolation="nearest").first()
    return Ranking(tuple(mean), tuple(spread), tuple(w), (cut["below"] + cut["above"]) / 2)


def score(ranking: Ranking, text: str = "text") -> Column:
    """The score of each text, 0 to 1; null counts as empty."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            x = np.array([features(t) for t in texts]).reshape(len(texts), len(NAMES))
            yield pd.Series(ranking.score(x))

    return scored(whole(text))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from the threshold on), one row per input row.

    The text alone makes the score: repeated texts get the same one, empty and null texts one of their own. A null doc_id is
    in no held-out fold. Without labels of both kinds every score is 0.5.
    """
    found = docs.select(F.col("doc_id"), score(fit(docs, labels)).alias("score"))
    return found.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
                        (F.col("score") >= CUT).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents from the threshold on, all their columns."""
    return docs.where(score(fit(docs, labels)) >= CUT)
