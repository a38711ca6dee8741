"""A corpus pipeline over the training-data operators: each stage is written as Parquet and read as the next one's documents."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from microbook.llm import bpe, lines, minhash, mixing, quality
from microbook.llm.common import stage, table
from microbook.llm.queries import BYTE_BPE

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def accept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten of them or more share."""
    return lines.cleaned(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, a similarity of 0.8 or more."""
    return minhash.kept(docs, 80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order in which their sources meet their weights, the square roots of their counts; places are stored."""
    return mixing.mixed(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, digests of the ids and of the text decoded from them, and block, slot and place in the mixture."""
    rows = docs.select(F.struct("doc_id", mixing.identity().alias("key")).alias("row"), "text")
    found = bpe.digests(rows, public_tokenizers.path(BYTE_BPE), "row")
    return mixing.with_places(found.select("doc_id.*", *[c for c in found.columns if c != "doc_id"]), docs, "key")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", accept), ("line dedup", drop_lines), ("near-duplicates", drop_near_copies), ("mixing", mix),
    ("byte-pair encoding", tokenize),
]
# SQL has neither the fitted score nor the tokenizer; the stages are tested one by one against brute force
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`; every stage but the last is written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs, name.replace(" ", "-"))
    return docs
