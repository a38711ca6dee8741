"""Token counts without token ids: pieces are counted once per distinct pre-token and joined to pre-token frequencies.

One pass over the documents counts the pre-tokens of the corpus; each distinct one is split into pieces once. The most frequent
pre-tokens, a fixed number of them whatever the corpus, go to every task, which sums them on the spot. The rest, rare by
definition, is joined by a shuffle on the pre-token and summed per document. No pre-token that a large share of the documents
holds reaches that shuffle, so it has no hot keys.
"""

from __future__ import annotations

import os
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from microbook.llm.common import stage, whole
from microbook.llm.pretoken import UNKNOWN, Classes, points_of, word_pieces

HEAD = 200_000  # pre-tokens, about, sent to every task: a few megabytes
HELD = 200_000  # distinct pre-tokens a task holds before it passes their counts on


class Splitter:
    """Pre-tokens of a text and pieces of a pre-token, as the tokenizer file has them."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread for one task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.classes = Classes(self.tokenizer.pre_tokenizer)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def normalised(self, text: str) -> str:
        """NFC and lower case of each character; white space only separates, so it stays as it is."""
        if text.isascii():
            return text.lower()
        if (self.classes.of[points_of(text)] == UNKNOWN).any() or self.tokenizer.normalizer is None:
            return self.tokenizer.normalizer.normalize_str(text) if self.tokenizer.normalizer else text
        text = unicodedata.normalize("NFC", text)
        return "".join([c.lower() for c in text]) if "Σ" in text else text.lower()

    def pre_tokens(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens in order, and the number of special strings between them."""
        parts, special = [text], 0
        for s in self.special:
            if s in text:
                parts = [q for p in parts for q in p.split(s)]
        special = len(parts) - 1
        if not special:
            return word_pieces(self.normalised(text), self.classes), 0
        return [p for part in parts for p in word_pieces(self.normalised(part), self.classes)], special

    def n_pieces(self, pre_tokens: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch(pre_tokens, add_special_tokens=False)]


@lru_cache(maxsize=2)
def splitter(path: str) -> Splitter:
    return Splitter(path)


def pre_token_pieces(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """piece (a distinct pre-token of the texts), freq (in all texts), n_pieces (of its tokens)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, seen = splitter(path), Counter()

        def passed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                              ["piece", "freq"])

        for batch in batches:
            for t in batch.column(0):
                seen.update(split.pre_tokens(t.as_py())[0])
                if len(seen) > HELD:
                    yield passed()
                    seen.clear()
        if seen:
            yield passed()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter(path)
        for batch in batches:
            n = pa.array(split.n_pieces(batch.column(0).to_pylist()), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, n], ["piece", "freq", "n_pieces"])

    counted = docs.select(whole(text).alias("text")).mapInArrow(count, "piece string, freq bigint")
    return counted.groupBy("piece").agg(F.sum("freq").alias("freq")).mapInArrow(pieces, "piece string, freq bigint, n_pieces int")


def frequent(pieces: DataFrame, head: int) -> DataFrame:
    """About `head` of the most frequent rows of `pieces` (piece, freq), without sorting them.

    Frequencies are counted in classes a 64th of an octave wide, at most some four thousand whatever the corpus. Classes are taken
    whole from the top as long as they fit, and of the next one the share that still fits, by a hash of the piece.
    """
    level = F.floor(F.log2("freq") * 64).cast("int")
    room, cut, share = head, None, 0.0
    for row in sorted(pieces.groupBy(level.alias("level")).count().collect(), reverse=True):
        if row["count"] > room:
            cut, share = row["level"], room / row["count"]
            break
        room -= row["count"]
    if cut is None:
        return pieces
    part = F.shiftrightunsigned(F.xxhash64("piece"), 12) / F.lit(float(1 << 52))
    return pieces.where((level > cut) | ((level == cut) & (part < share)))


def token_counts(docs: DataFrame, path: str, limit: int = 2048, head: int = HEAD, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit), one row per input row.

    Null and empty texts have 0 bytes and 0 tokens; repeated rows are counted each; a null doc_id stays null. `head` changes
    only where sums are made, never what they are.
    """
    spark = docs.sparkSession
    pieces = stage(pre_token_pieces(docs, path, text), "pre-tokens")
    top = frequent(pieces, head).select("piece", "n_pieces").toArrow()
    shared = spark.sparkContext.broadcast((top.column(0).to_pylist(), top.column(1).to_pylist()))
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"))
    schema = T.StructType([T.StructField("row", T.LongType()), rows.schema["doc_id"], T.StructField("n_bytes", T.LongType()),
                           T.StructField("known", T.LongType()), T.StructField("piece", T.StringType()),
                           T.StructField("freq", T.LongType())])

    def split_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each document with what the head gives, and one for each of its other pre-tokens."""
        split = splitter(path)
        known = dict(zip(*shared.value))
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids, n_bytes, sums, names, freqs, place = [], [], [], [], [], []
            for i, t in enumerate(batch.column(1)):
                one = t.as_py()
                found, total = split.pre_tokens(one)
                row += 1
                start = len(ids)
                ids.append(row)
                names.append(f"\0{row}")  # equals no pre-token, which never joins signs and digits
                freqs.append(0)
                for piece, freq in Counter(found).items():
                    n = known.get(piece)
                    if n is None:
                        ids.append(row)
                        names.append(piece)
                        freqs.append(freq)
                    else:
                        total += n * freq
                rest = [None] * (len(ids) - start - 1)
                place += [i, *rest]
                n_bytes += [len(one.encode("utf-8", "surrogatepass")), *rest]
                sums += [total, *rest]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pc.take(batch.column(0), pa.array(place, pa.int32())), pa.array(n_bytes, pa.int64()),
                 pa.array(sums, pa.int64()), pa.array(names, pa.string()), pa.array(freqs, pa.int64())],
                ["row", "doc_id", "n_bytes", "known", "piece", "freq"])

    tokens = (rows.mapInArrow(split_rows, schema).join(pieces.select("piece", "n_pieces"), "piece", "left")
              .groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"),
                                  (F.max("known") + F.sum(F.coalesce(F.col("freq") * F.col("n_pieces"), F.lit(0)))).alias("n_tokens")))
    return tokens.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
