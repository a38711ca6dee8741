"""Exact dedup by content-defined chunk recipes.

A text is cut where its own characters say so, each chunk gets an identifier, and texts are equal if their ordered lists of
identifiers are. Chunks move once, to find out whether any two different ones share a hash; documents never move.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from microbook.llm.common import SPACE_RUN, stage, whole

LEAST, MOST = 512, 8192
# a chunk ends after the first such pair of characters beyond the least length (about one place in 200), or at the most
ENDS = r"[aeiouäéíóAEIOU0-4][.,;:!?dgDG5-9]"


def chunked(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """The chunks of a text; together they are the text."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{{least - 2},{most - 2}}}?{ENDS}|.{{1,{most}}}"), F.lit(0))


def groups(docs: DataFrame, least: int = LEAST, most: int = MOST, hashed: Callable[[Column], Column] = F.xxhash64,
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, one row per input row, dropped ones too.

    Runs of white space count as one space. Null and empty texts are equal to each other. Rows that repeat a doc_id count in
    group_size, and all those with the smallest doc_id are kept. Null ids come last; a group of only null ids keeps them all.
    `hashed` may be any hash: chunks that share one are told apart by an ordinal.
    """
    normal = docs.select(F.col(doc_id).alias("doc_id"), F.regexp_replace(whole(text), SPACE_RUN, " ").alias("text"))
    cut = normal.select("doc_id", F.sha2("text", 256).alias("text_sha256"), chunked(F.col("text"), least, most).alias("chunks"))
    distinct = cut.select(F.explode("chunks").alias("chunk")).select(hashed(F.col("chunk")).alias("hash"), "chunk").distinct()
    shared = stage(distinct.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "shared-hashes")
    if shared.isEmpty():
        recipes = cut.select("doc_id", "text_sha256", F.transform("chunks", lambda c: hashed(c)).alias("recipe"))
    else:
        recipes = _with_ordinals(cut, distinct, shared, hashed)
    recipes = stage(recipes.withColumn("key", F.xxhash64("recipe")), "recipes")
    kept = recipes.groupBy("key", "recipe").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    both = recipes.join(kept, ["key", "recipe"])
    return both.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def _with_ordinals(cut: DataFrame, distinct: DataFrame, shared: DataFrame, hashed: Callable[[Column], Column]) -> DataFrame:
    """Recipes whose identifiers are hash and ordinal: chunks that share a hash are numbered in the order of their text."""
    numbered = distinct.join(shared, "hash").withColumn("n", F.row_number().over(Window.partitionBy("hash").orderBy("chunk")))
    numbered = stage(numbered, "numbered-chunks")
    rows = cut.withColumn("row", F.monotonically_increasing_id())
    placed = (rows.select("row", "doc_id", "text_sha256", F.posexplode_outer("chunks").alias("place", "chunk"))
              .withColumn("hash", hashed(F.col("chunk"))).join(numbered, ["hash", "chunk"], "left"))
    listed = F.sort_array(F.collect_list(F.when(F.col("place").isNotNull(), F.struct("place", "hash", F.coalesce("n", F.lit(0)).alias("n")))))
    return (placed.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("text_sha256").alias("text_sha256"), listed.alias("listed"))
            .select("doc_id", "text_sha256", F.transform("listed", lambda x: F.struct(x["hash"], x["n"])).alias("recipe")))
