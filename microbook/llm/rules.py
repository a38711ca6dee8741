"""Quality rules: a table of thresholds compiled into projections of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from microbook.llm.common import NOT_SPACE, SPACE_RUN, whole

PLACE_BITS = 28  # for the place of a word, the other bits for the hash of its window

# fixed values: frequent function words of four languages
STOP_WORDS = ("the", "of", "and", "to", "a", "in", "is", "that", "it", "was", "for", "on", "are", "with", "as", "be", "at", "by",
              "der", "die", "das", "und", "zu", "den", "von", "mit", "ist", "im", "dem", "nicht", "ein", "eine", "auf", "sich",
              "de", "la", "le", "et", "les", "des", "un", "une", "en", "du", "que", "est", "pour", "dans", "qui", "sur",
              "el", "los", "y", "del", "se", "las", "por", "con", "no", "una", "su", "para")


@dataclass(frozen=True)
class Rule:
    """A ratio of two measures and the range it must keep to."""

    name: str
    over: str
    under: str
    low: float | None = None
    high: float | None = None

    def broken(self) -> Column:
        ratio = F.col(self.over) / F.greatest(F.col(self.under), F.lit(1))
        tests = [ratio < self.low] * (self.low is not None) + [ratio > self.high] * (self.high is not None)
        return reduce(Column.__or__, tests)


RULES = (
    Rule("word_length", "word_chars", "n_words", 2.0, 20.0),
    Rule("symbols", "n_symbols", "n_words", high=0.2),
    Rule("exclamation", "n_bangs", "n_words", high=0.5),
    Rule("stop_words", "n_stop_words", "n_words", low=0.02),
    Rule("same_lines", "n_dup_lines", "n_lines", high=0.5),
    Rule("line_length", "n_lines", "n_words", high=0.5),
)


def _neighbours_equal(found: Column, same) -> Column:
    """Elements of a sorted array that equal the one before or after."""
    return F.filter(found, lambda x, j: F.coalesce(same(x, F.get(found, j - 1)), F.lit(False))
                    | F.coalesce(same(x, F.get(found, j + 1)), F.lit(False)))


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and all measures of the rules.

    Repeated windows are found by sorting: the hash of each three words with its place in one long, equal hashes side by side;
    what they name is then compared word for word. Each projection uses the last one's arrays, so a text is split once.
    """
    one = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"))
    split = one.select(
        "doc_id", F.array_remove(F.split("text", SPACE_RUN), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(NOT_SPACE)).alias("lines"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        F.regexp_count("text", F.lit("!")).alias("n_bangs"))
    mask = F.lit((1 << PLACE_BITS) - 1).cast("bigint")

    def packed(i: Column) -> Column:
        window = F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))
        return F.shiftleft(window, PLACE_BITS).bitwiseOR(i.cast("bigint"))

    n_words = F.size("words")
    counted = split.select(
        "doc_id", "words", "n_symbols", "n_bangs", n_words.cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"), F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.size(F.filter("words", lambda w: w.isin(*STOP_WORDS))).alias("n_stop_words"),
        F.when(n_words > 2, F.sort_array(F.transform(F.sequence(F.lit(0), n_words - 3), packed)))
        .otherwise(F.array().cast("array<bigint>")).alias("windows"))
    measures = [c for c in counted.columns if c not in ("words", "windows")]
    alike = counted.select(*measures, "words", _neighbours_equal(
        F.col("windows"), lambda a, b: F.shiftright(a, PLACE_BITS) == F.shiftright(b, PLACE_BITS)).alias("alike"))

    def spelled(x: Column) -> Column:
        i = x.bitwiseAND(mask).cast("int")
        return F.struct(F.get("words", i).alias("a"), F.get("words", i + 1).alias("b"), F.get("words", i + 2).alias("c"), i.alias("i"))

    spelt = alike.select(*measures, F.sort_array(F.transform("alike", spelled)).alias("spelt"))
    equal = spelt.select(*measures, F.sort_array(F.transform(_neighbours_equal(
        F.col("spelt"), lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])), lambda x: x["i"])).alias("places"))
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("last"))
    covered = F.aggregate("places", start, lambda s, x: F.struct(
        (s["n"] + F.least(F.lit(3), x - s["last"])).alias("n"), x.alias("last")), lambda s: s["n"])
    return equal.select(*measures, covered.alias("n_repeat_words"))


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, broken (names of broken rules).

    One row per input row. Null and empty texts have no words, so base_failed is true. Rows are independent: repeated rows stay
    and a null doc_id stays null. Texts of under 2^28 words are measured exactly.
    """
    found = measured(docs, doc_id, text)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    broken = F.array_compact(F.array(*[F.when(r.broken(), F.lit(r.name)) for r in rules]))
    judgement = found.select("*", failed.alias("base_failed"), broken.alias("broken"))
    return judgement.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                            (~F.col("base_failed") & (F.size("broken") == 0)).alias("kept"), "broken")
