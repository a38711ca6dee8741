"""Fill-in-middle transformation over a learned rank index.

A text of n units has n + 1 boundary offsets. They are not kept as a list: error-bounded line segments from rank to offset are
fitted to all of them, and what a line misses at a rank is kept as one signed byte. A cut at any rank is the prediction of its
segment plus the stored residual, which is exact. A unit is a run of ASCII letters or any other single character.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from microbook.llm.common import whole
from microbook.llm.pretoken import points_of

BOUND = 127  # a residual fits a signed byte
FIRST_LOOK = 256  # ranks tried at first when a segment is fitted; doubled while the segment holds
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM = 90  # of 100 texts, those from here on stay as they are
SUFFIX_FIRST = 20  # of 100 transformed texts, those below put the suffix first


def boundaries(text: str) -> np.ndarray:
    """Offsets, in code points, at which a unit starts, and the end of the text."""
    points = points_of(text)
    lower = points | np.uint32(32)
    letter = (lower >= 97) & (lower <= 122)  # the bit maps only A-Z onto a-z
    starts = np.ones(len(points) + 1, bool)
    starts[1:-1] = ~(letter[1:] & letter[:-1])
    return np.flatnonzero(starts) if len(points) else np.zeros(1, np.int64)


@dataclass
class RankIndex:
    """Segments by their first rank, offset there and slope, and a residual for every rank."""

    first: np.ndarray
    at: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    @property
    def n(self) -> int:
        """Number of units."""
        return len(self.residual) - 1

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        segment = np.searchsorted(self.first, ranks, "right") - 1
        return self.at[segment] + np.rint((ranks - self.first[segment]) * self.slope[segment]).astype(np.int64)

    def offset(self, rank: int) -> int:
        """The boundary after `rank` units."""
        return int(self.predict(np.array([rank]))[0]) + int(self.residual[rank])


def fit(offsets: np.ndarray, bound: int = BOUND) -> RankIndex:
    """Cover the offsets with segments, each as long as some line through its first point stays within `bound` of every other."""
    first, at, slope = [], [], []
    start, n = 0, len(offsets)
    while start < n:
        origin = offsets[start]
        low, high, end, look = -np.inf, np.inf, start + 1, FIRST_LOOK
        while end < n:
            to = min(end + look, n)
            run = np.arange(end - start, to - start)
            rise = offsets[end:to] - origin
            lows = np.maximum(np.maximum.accumulate((rise - bound) / run), low)
            highs = np.minimum(np.minimum.accumulate((rise + bound) / run), high)
            broken = lows > highs
            held = int(broken.argmax()) if broken.any() else len(run)
            if held:
                low, high, end = lows[held - 1], highs[held - 1], end + held
            if held < len(run):
                break
            look *= 2
        first.append(start)
        at.append(int(origin))
        slope.append((low + high) / 2 if end > start + 1 else 0.0)
        start = end
    index = RankIndex(np.array(first), np.array(at, np.int64), np.array(slope), np.zeros(n, np.int8))
    # the line misses a boundary by `bound` at most, its rounded value by less than a half more: a whole number within `bound`
    index.residual = (offsets - index.predict(np.arange(n))).astype(np.int8)
    return index


def transform(text: str, index: RankIndex, draws: tuple[int, int, int, int], plain_from: int = PLAIN_FROM,
              suffix_first: int = SUFFIX_FIRST) -> tuple[str, str, int | None, int | None]:
    """(form, output, prefix length, middle length); the four draws choose both cuts, whether to transform, and the form."""
    if not text or draws[2] % 100 >= plain_from or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return "plain", text, None, None
    ranks = sorted(draw % (index.n + 1) for draw in draws[:2])
    a, b = index.offset(ranks[0]), index.offset(ranks[1])
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if draws[3] % 100 < suffix_first:
        return "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}", a, b - a
    return "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}", a, b - a


def restore(output: str, form: str) -> str:
    """The text behind an output, from the output and its form alone."""
    if form == "plain":
        return output
    one, two = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    head, rest = output[len(one):].split(two, 1)
    tail, middle = rest.split(MIDDLE, 1)
    return head + middle + tail if form == "psm" else tail + middle + head


def draws_of(doc_id: str, seed: int = 1) -> list:
    """Four numbers below 2^32 from the document's id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint").alias(f"h{i + 1}") for i in range(4)]


def _mapped(docs: DataFrame, doc_id: str, text: str, seed: int, fields: list[tuple[str, T.DataType]], each) -> DataFrame:
    """Run `each(text, draws)` on every row; its tuple fills `fields`."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"), *draws_of(doc_id, seed))
    schema = T.StructType([rows.schema["doc_id"], *[T.StructField(name, kind) for name, kind in fields]])
    names = [name for name, _ in fields]
    kinds = [{T.LongType: pa.int64(), T.StringType: pa.string(), T.BinaryType: pa.binary()}.get(type(kind)) or
             pa.list_(pa.struct([("first", pa.int64()), ("at", pa.int64()), ("slope", pa.float64())])) for _, kind in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            draws = zip(*[batch.column(i).to_pylist() for i in range(2, 6)])
            found = [each(value.as_py(), four) for value, four in zip(batch.column(1), draws)]
            values = zip(*found) if found else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(v, kind) for v, kind in zip(values, kinds)]], ["doc_id", *names])

    return rows.mapInArrow(run, schema)


def indexed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bound: int = BOUND) -> DataFrame:
    """The index of every text: doc_id, n units, segments (first rank, offset there, slope), residuals (a signed byte a rank).

    Null and empty texts have one boundary, 0. Texts are indexed whole; rows are never compared, so ties and repeated rows stay.
    `bound` is at most 127.
    """
    if not 1 <= bound < BOUND + 1:
        raise ValueError("residuals are signed bytes: bound is 1 to 127")
    segment = T.StructType([T.StructField("first", T.LongType()), T.StructField("at", T.LongType()), T.StructField("slope", T.DoubleType())])
    fields = [("n", T.LongType()), ("segments", T.ArrayType(segment)), ("residuals", T.BinaryType())]

    def each(value: str, _: tuple) -> tuple:
        index = fit(boundaries(value), bound)
        segments = [{"first": f, "at": a, "slope": s} for f, a, s in zip(index.first.tolist(), index.at.tolist(), index.slope.tolist())]
        return index.n, segments, index.residual.tobytes()

    return _mapped(docs, doc_id, text, 1, fields, each)


OUTPUT = [("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType()), ("middle_chars", T.LongType())]


def transformed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = 1, plain_from: int = PLAIN_FROM,
                suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """doc_id, n units, form (plain, psm, spm), prefix_chars, middle_chars (null if plain), output; one row per input row.

    Null and empty texts and texts that hold a mark stay plain. The draws depend on seed and doc_id alone (null: no digits), so
    repeated rows get the same output. Other columns are not read.
    """
    def each(value: str, draws: tuple) -> tuple:
        index = fit(boundaries(value))
        form, output, a, b = transform(value, index, draws, plain_from, suffix_first)
        return index.n, form, a, b, output

    return _mapped(docs, doc_id, text, seed, [*OUTPUT, ("output", T.StringType())], each)


def restored(outputs: DataFrame, doc_id: str = "doc_id", output: str = "output", form: str = "form") -> DataFrame:
    """doc_id and the text behind each output, in SQL functions; marks stand once in an output that is not plain."""
    out, kind = whole(output), F.col(form)
    one = F.when(kind == "psm", F.lit(PREFIX)).otherwise(F.lit(SUFFIX))
    two = F.when(kind == "psm", F.lit(SUFFIX)).otherwise(F.lit(PREFIX))
    cut, end = F.instr(out, two), F.instr(out, F.lit(MIDDLE))
    head = F.substring(out, F.length(one) + 1, cut - F.length(one) - 1)
    tail = F.substring(out, cut + F.length(two), end - cut - F.length(two))
    middle = F.substring(out, end + len(MIDDLE), F.length(out))
    text = F.when(kind == "plain", out).when(kind == "psm", F.concat(head, middle, tail)).otherwise(F.concat(tail, middle, head))
    return outputs.select(F.col(doc_id).alias("doc_id"), text.alias("text"))


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = 1) -> DataFrame:
    """`transformed` with digests in place of the texts: of the output, and of the text rebuilt from output and form."""
    def sha(value: str) -> str:
        return hashlib.sha256(value.encode("utf-8", "replace")).hexdigest()

    def each(value: str, draws: tuple) -> tuple:
        index = fit(boundaries(value))
        form, output, a, b = transform(value, index, draws)
        return index.n, form, a, b, sha(output), sha(restore(output, form))

    return _mapped(docs, doc_id, text, seed, [*OUTPUT, ("output_sha256", T.StringType()), ("restored_sha256", T.StringType())], each)
