"""Secrets in texts: fixed patterns, and windows of high Shannon entropy in strings that look like keys."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from microbook.llm.common import whole

Span = tuple[int, int, int]  # start, place of the kind in KINDS, end

# fixed values: the kinds in their order, their patterns and least lengths
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # the whole run of 18 or more: a shorter run has no longer match inside it
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGNED = 12


@dataclass(frozen=True)
class Entropy:
    """Windows, least bits per character and least number of kinds of character, by class; and what is never a secret."""

    least: int = 20
    classes: tuple[tuple[str, str, float], ...] = (
        # name, characters, bits per character that a window must reach: random windows of 20 have 3.4 at the median in hex (0.5 %
        # less than 2.85) and 4.0 in base64 (0.5 % less than 3.58, 3.34 without capitals)
        ("hex", r"[0-9a-fA-F]+", 2.85),
        ("base64", r"[A-Za-z0-9+/_-]+={0,2}", 3.4),
    )
    # turns between kinds of character, but from a capital to a small letter, that base64 windows in a row must have
    turns: int = 3
    sure: float = 4.1  # bits that need no turns
    # allow-list, each against the whole candidate: words, plain or in camel case, ids of fixed form, paths, numbers
    allow: tuple[str, ...] = (
        r"(?:[A-Z]?[a-z]{3,}|[A-Z]{2,}(?![a-z])|[A-Z][a-z]{1,2}(?=[A-Z_/=+-]|$)|[_/=+-]+[a-z]{0,2}(?=[A-Z_/=+-]|$))+",
        r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
        r"[0-9_/=+-]+",
        r"[A-Za-z]*[0-9]{0,4}(?:[_/-][A-Za-z]*[0-9]{0,4})+",
    )


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns, leftmost and non-overlapping within a kind; those too short are dropped after matching."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGNED]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    return sorted(spans + [(m.start(), 2, m.end()) for m in HEX.finditer(text)])


class EntropyScan:
    """Sliding windows of a fixed length; the counts change by the character that enters and the one that leaves."""

    def __init__(self, rules: Entropy) -> None:
        n = self.least = rules.least
        self.term = [0.0] + [c * math.log2(c) for c in range(1, n + 1)]
        self.candidates = re.compile(rf"[A-Za-z0-9+/_-]{{{n},}}={{0,2}}")
        self.turns, self.sure = rules.turns, rules.sure
        self.turn = re.compile(r"[a-z](?=[A-Z0-9])|[A-Z](?=[0-9])|[0-9](?=[A-Za-z])")
        self.classes = [(name, re.compile(chars), bits) for name, chars, bits in rules.classes]
        self.allow = re.compile("|".join(f"(?:{a})" for a in rules.allow)) if rules.allow else None

    def windows(self, run: str, bits: float) -> list[tuple[int, int]]:
        """Unions of the overlapping windows of `run` whose entropy is at least `bits` per character."""
        n, term, counts, total, out = self.least, self.term, dict.fromkeys(run, 0), 0.0, []
        for i, c in enumerate(run):
            if i >= n:
                gone = run[i - n]
                total -= term[counts[gone]] - term[counts[gone] - 1]
                counts[gone] -= 1
            total += term[counts[c] + 1] - term[counts[c]]
            counts[c] += 1
            if i >= n - 1 and math.log2(n) - total / n >= bits - 1e-9:
                start = i - n + 1
                if out and start <= out[-1][1]:
                    out[-1] = (out[-1][0], i + 1)
                else:
                    out.append((start, i + 1))
        return out

    def spans(self, text: str) -> list[Span]:
        """The candidates that hold a window of high entropy, whole: what is left of a key outside its span would be lost."""
        found: list[Span] = []
        for m in self.candidates.finditer(text):
            candidate = m.group()
            if self.allow and self.allow.fullmatch(candidate):
                continue
            if any(run.end() - run.start() >= self.least and self.hot(name, run.group(), bits)
                   for name, chars, bits in self.classes for run in chars.finditer(candidate)):
                found.append((m.start(), 3, m.end()))
        return found

    def hot(self, name: str, run: str, bits: float) -> bool:
        """Whether `run` has windows of high entropy that are more than words in a row."""
        found = self.windows(run, bits)
        if name == "hex" or not found:
            return bool(found)
        return any(sum(1 for _ in self.turn.finditer(run, a, b)) >= self.turns for a, b in found) or bool(self.windows(run, self.sure))


def named(spans: list[Span]) -> str:
    return ",".join([f"{KINDS[k]}:{a}:{b}" for a, k, b in spans])


def scan(docs: DataFrame, rules: Entropy = Entropy(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans; one row per input row.

    Spans are kind:start:end in code points, end exclusive, by start and then kind. Null and empty texts have none, and the
    digest of nothing. Rows are independent: repeated rows stay, a null doc_id stays null.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"))
    counts = ["n_assign", "n_access", "n_hex", "n_entropy"]
    schema = T.StructType([rows.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in counts],
                           T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entropy = EntropyScan(rules)
        for batch in batches:
            n: list[list[int]] = [[] for _ in counts]
            digests, spans = [], []
            for t in batch.column(1):
                one = t.as_py()
                base, more = base_spans(one), entropy.spans(one)
                for k in range(4):
                    n[k].append(sum(s[1] == k for s in (base if k < 3 else more)))
                digests.append(hashlib.sha256(named(base).encode()).hexdigest())
                spans.append(named(sorted(base + more)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(x, pa.int64()) for x in n], pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                ["doc_id", *counts, "base_sha256", "spans"])

    return rows.mapInArrow(run, schema)
