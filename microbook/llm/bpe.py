"""Byte-pair encoding as a streaming transducer with bounded lookahead, and decoding as an incremental state machine.

Encoding reads a text in chunks. A piece of the pre-token pattern is emitted once no later character can change it. Inside a
long piece the merges run on a window; a token is emitted once it ends further from the window's end than the lookahead that
the merge list needs. What follows a token boundary is encoded as if it stood alone, so the window moves on from there, and
memory depends on the chunk, the lookahead and the cache, never on the text.
"""

from __future__ import annotations

import bisect
import codecs
import hashlib
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from microbook.llm.common import whole
from microbook.llm.pretoken import SPACE, Classes, byte_pieces, points_of

SHIFT = 20
NONE = 1 << 60
NO_RULE = np.int32(2**31 - 1)
SHORT = 24  # bytes of a piece up to which the list itself is quicker than the equivalent rule
WIDTHS = (3, 5, 7, 9, 12, 16, 24)  # lengths to which short pieces are filled up when they are merged together
WIDTH_OF = [next(w for w in WIDTHS if w >= n) for n in range(SHORT + 1)]
MANY = 64  # short pieces from which on they are merged together
GROUP = 1 << 18  # characters of short texts whose unknown pieces are merged together
KNOWN = 200_000  # pieces kept; when so many are there, those not used since the last time go


def byte_names() -> list[str]:
    """The printable name of each byte in vocabulary files: itself if printable, else the next free code point from 256."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b if b in own else next(free)) for b in range(256)]


def sufficient_lookahead(merges: list[tuple[int, int, int]], length: dict[int, int]) -> int:
    """Bytes before the end of what was read beyond which no later byte can change a token.

    Merge in order of rank the text read so far and any continuation of it, and follow the last boundary up to which both agree.
    A rule (u, v) can move it left by the length of u only if u ends there and v starts there in one of the two. The token that
    starts there then has u' of the last move on its left edge, merged no earlier than that move. So the moves are a chain of
    rules of rising rank in which u of each lies on the left edge of v of the next; the longest such chain bounds the way.
    """
    left = {token: u for u, _, token in merges}
    rank = {token: r for r, (_, _, token) in enumerate(merges)}
    reached: dict[int, tuple[list[int], list[int]]] = {}
    most = 0
    for r, (u, v, _) in enumerate(merges):
        edge, by, before = v, r, 0
        while True:
            if edge in reached:
                ranks, totals = reached[edge]
                i = bisect.bisect_right(ranks, by) - 1
                if i >= 0:
                    before = max(before, totals[i])
            if edge not in left:
                break
            by, edge = rank[edge], left[edge]
        total = length[u] + before
        most = max(most, total)
        ranks, totals = reached.setdefault(u, ([], []))
        ranks.append(r)
        totals.append(max(total, totals[-1] if totals else 0))
    return most


class Merges:
    """A byte-level vocabulary and merge list read from a tokenizer file, with its lookahead."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        names = byte_names()
        value = {name: byte for byte, name in enumerate(names)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: bytes(value[c] for c in name) for name, i in vocab.items() if name not in self.special}
        self.bytes_of |= {i: name.encode() for name, i in self.special.items()}
        self.byte_id = [vocab[name] for name in names]
        rules = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in rules]
        made = set(self.byte_id)
        for u, v, token in self.merges:
            if u not in made or v not in made or token in made:
                raise ValueError("the lookahead holds for merge lists that build each token once from earlier ones")
            made.add(token)
        self.rule = {(u << SHIFT) | v: (r << SHIFT) | token for r, (u, v, token) in enumerate(self.merges)}
        keys = np.array(list(self.rule), np.int64)
        order = np.argsort(keys)
        self.pairs, self.ranks = keys[order], order.astype(np.int32)
        self.products = np.array([token for _, _, token in self.merges], np.int32)
        self.byte_tokens = ids = np.array(self.byte_id, np.int32)
        self.first_pairs = self.ranks_of(np.repeat(ids, 256), np.tile(ids, 256)).reshape(256, 256)
        # tokens that their own bytes give, by bytes; the longest such token for each two first bytes
        self.token_of = {b: i for i, b in self.bytes_of.items() if i in made and self.merge(b) == [i]}
        self.reach: dict[bytes, int] = {}
        for b in self.token_of:
            self.reach[b[:2]] = max(len(b), self.reach.get(b[:2], 0))
        self.apart: dict[int, bool] = {}
        self.lookahead = sufficient_lookahead(self.merges, {i: len(b) for i, b in self.bytes_of.items()})
        self.classes = Classes(Tokenizer.from_file(path).pre_tokenizer)

    def apply(self, data: bytes) -> list[int]:
        """Tokens of one piece.

        A row of tokens is the result of the merges if and only if each neighbouring pair stays apart when merged alone, so the
        piece is its longest first token whose neighbour, the first token of the rest, lets it stand.
        """
        end = len(data)
        if end <= SHORT:
            return self.merge(data)
        first: dict[int, int] = {}
        token_of, bytes_of, reach, apart = self.token_of, self.bytes_of, self.reach, self.apart

        def head(at: int) -> int:
            longest = min(end, at + reach.get(data[at:at + 2], 1))
            for to in range(longest, at, -1):
                token = token_of.get(data[at:to])
                if token is None:
                    continue
                if to < end:
                    right = first.get(to)
                    if right is None:
                        right = head(to)
                    together = apart.get((token << SHIFT) | right)
                    if together is None:
                        together = self.stay_apart(token, right)
                    if not together:
                        continue
                first[at] = token
                return token
            raise AssertionError("single bytes are tokens")

        out, at = [], 0
        while at < end:
            token = first.get(at)
            if token is None:
                token = head(at)
            out.append(token)
            at += len(bytes_of[token])
        return out

    def stay_apart(self, left: int, right: int) -> bool:
        found = self.merge(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        if len(self.apart) < 500_000:
            self.apart[(left << SHIFT) | right] = found
        return found

    def merge(self, data: bytes) -> list[int]:
        """Merge the bytes by the list itself, lowest rank first, leftmost first."""
        parts = [self.byte_id[b] for b in data]
        rule = self.rule.get
        best = [rule((a << SHIFT) | b, NONE) for a, b in zip(parts, parts[1:])]
        while best and (lowest := min(best)) != NONE:
            i = best.index(lowest)
            parts[i:i + 2] = [lowest & ((1 << SHIFT) - 1)]
            del best[i]
            if i:
                best[i - 1] = rule((parts[i - 1] << SHIFT) | parts[i], NONE)
            if i < len(best):
                best[i] = rule((parts[i] << SHIFT) | parts[i + 1], NONE)
        return parts

    def entry(self, ids: list[int]) -> tuple[tuple[int, ...], str, bytes]:
        return tuple(ids), ",".join(map(str, ids)), b"".join([self.bytes_of[i] for i in ids])

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the rule for each pair of tokens; NO_RULE without one, or where the second token is -1."""
        keys = (left.astype(np.int64) << SHIFT) | right
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[at] == keys, self.ranks[at], NO_RULE)

    def merge_many(self, pieces: list[bytes]) -> list[list[int]]:
        """`merge` for many short pieces at once: a row each, and every round merges the lowest rank of every row."""
        out: list[list[int]] = [[] for _ in pieces]
        by_width: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            by_width.setdefault(WIDTH_OF[len(piece)], []).append(k)
        for width, which in by_width.items():
            # shorter pieces are filled up with -1
            data = np.frombuffer(b"".join([pieces[k].ljust(width, b"\0") for k in which]), np.uint8).reshape(len(which), width)
            filled = np.arange(width) < np.array([len(pieces[k]) for k in which])[:, None]
            parts = np.full((len(which), width + 1), -1, np.int32)
            parts[:, :width] = np.where(filled, self.byte_tokens[data], -1)
            best = np.full((len(which), width), NO_RULE)
            best[:, :width - 1] = np.where(filled[:, 1:], self.first_pairs[data[:, :-1], data[:, 1:]], NO_RULE)
            rows = np.array(which)
            while True:
                i = best.argmin(1)
                lowest = best[np.arange(len(rows)), i]
                open_ = lowest != NO_RULE
                if not open_.all():
                    for k, tokens in zip(rows[~open_].tolist(), parts[~open_].tolist()):
                        out[k] = tokens[:tokens.index(-1)]
                    if not open_.any():
                        break
                    rows, parts, best, i, lowest = rows[open_], parts[open_], best[open_], i[open_], lowest[open_]
                at, columns = np.arange(len(rows)), np.arange(best.shape[1])
                # close the gap behind the merged pair; the last column of `parts` is always -1
                parts[:, :-1] = np.where(columns > i[:, None], parts[:, 1:], parts[:, :-1])
                best[:, :-1] = np.where(columns[:-1] >= i[:, None], best[:, 1:], best[:, :-1])
                parts[at, i] = self.products[lowest]
                best[at, i] = self.ranks_of(parts[at, i], parts[at, i + 1])
                before = i > 0
                best[at[before], i[before] - 1] = self.ranks_of(parts[at[before], i[before] - 1], parts[at[before], i[before]])
        return out


@lru_cache(maxsize=4)
def merges_of(path: str) -> Merges:
    return Merges(path)


class PieceStream:
    """One piece that may be longer than memory: bytes in, stable tokens out."""

    def __init__(self, merges: Merges, window: int) -> None:
        self.merges, self.window, self.held = merges, window, b""

    def feed(self, data: bytes) -> list[int]:
        out: list[int] = []
        for at in range(0, len(data), self.window):
            self.held += data[at:at + self.window]
            stable = len(self.held) - self.merges.lookahead
            if stable < self.window:
                continue
            end = 0
            for token in self.merges.apply(self.held):
                if end + len(self.merges.bytes_of[token]) > stable:
                    break
                end += len(self.merges.bytes_of[token])
                out.append(token)
            self.held = self.held[end:]
        return out

    def finish(self) -> list[int]:
        out = self.merges.apply(self.held)
        self.held = b""
        return out


Entry = tuple[tuple[int, ...], str, bytes]  # the ids of a piece, their decimal text, and the bytes that they stand for
Run = list[str] | list[Entry]  # neighbouring pieces, or what is encoded already


class Pieces:
    """The entries of pieces. Short ones are kept in two generations: what one does not use until it is full is dropped."""

    def __init__(self, merges: Merges, window: int = 256, known: int = KNOWN) -> None:
        self.merges, self.window, self.known = merges, window, known
        self.now: dict[str, Entry] = {}
        self.before: dict[str, Entry] = {}

    def _encoded(self, data: bytes) -> list[int]:
        if len(data) <= self.window:
            return self.merges.apply(data)
        stream = PieceStream(self.merges, self.window)
        return stream.feed(data) + stream.finish()

    def entries(self, texts: list[list[Run]]) -> list[list[Entry]]:
        """The entries of each text, given as runs; all unknown short pieces are merged together."""
        if len(self.now) > self.known:
            self.now, self.before = {}, self.now
        get = self.now.get
        found = [[list(map(get, run)) if isinstance(run[0], str) else run for run in runs] for runs in texts]
        unknown = [(x, y) for x, entries in enumerate(found) for y, run in enumerate(entries) if None in run]
        long = self._learn({p for x, y in unknown for p, entry in zip(texts[x][y], found[x][y]) if entry is None})
        for x, y in unknown:
            found[x][y] = [get(p) or long[p] for p in texts[x][y]]
        return [list(chain.from_iterable(entries)) for entries in found]

    def _learn(self, unknown: set[str]) -> dict[str, Entry]:
        """Encode unknown pieces; those over 64 bytes are returned, the others kept."""
        new, long = [], {}
        for piece in unknown:
            kept = self.before.get(piece)
            if kept:
                self.now[piece] = kept
            else:
                new.append(piece)
        data = [piece.encode("utf-8", "surrogatepass") for piece in new]
        short = [k for k, b in enumerate(data) if len(b) <= SHORT]
        merged: dict[int, list[int]] = {}
        if len(short) >= MANY:
            merged = dict(zip(short, self.merges.merge_many([data[k] for k in short])))
        for k, piece in enumerate(new):
            ids = merged[k] if k in merged else self._encoded(data[k])
            (self.now if len(data[k]) <= 64 else long)[piece] = self.merges.entry(ids)
        return long


class Encoder:
    """Text in, token ids out, in any chunks: `feed` returns the ids that are stable, `finish` the rest."""

    def __init__(self, merges: Merges, window: int = 256, pieces: Pieces | None = None) -> None:
        self.merges, self.window = merges, window
        self.pieces = pieces or Pieces(merges, window)
        self.held = ""
        self.open: PieceStream | None = None
        self.open_class = -1
        self.longest = max(map(len, merges.special), default=0)

    def _plain(self, ids: list[int]) -> list[Run]:
        return [[self.merges.entry(ids)]] if ids else []

    def _continue(self, text: str) -> tuple[list, str]:
        """Give the open piece what belongs to it; returns its stable tokens and the text after it."""
        kind = self.merges.classes(points_of(text))
        other = kind != self.open_class
        n = int(other.argmax()) if other.any() else len(text)
        whole_run = n == len(text)
        if self.open_class == SPACE:  # the last space may go to what follows
            n -= 1
        ids = self.open.feed(text[:max(n, 0)].encode("utf-8", "surrogatepass"))
        if not whole_run:
            ids += self.open.finish()
            self.open = None
        return self._plain(ids), text[max(n, 0):]

    def _part(self, text: str, last: bool) -> tuple[list[Run], str]:
        """Runs of the stable pieces of `text`, and the text that is held back."""
        out: list = []
        if self.open and text:
            done, text = self._continue(text)
            out += done
            if self.open and not last:
                return out, text
        if self.open and last:
            ids = self.open.feed(text.encode("utf-8", "surrogatepass")) + self.open.finish()
            self.open = None
            return out + self._plain(ids), ""
        pieces = byte_pieces(text, self.merges.classes)
        if last:
            return out + ([pieces] if pieces else []), ""
        # a piece is stable if a character follows it and three are known from its start on (the longest ending)
        cut = len(text)
        while pieces and (cut == len(text) or cut - len(pieces[-1]) + 3 > len(text)):
            cut -= len(pieces.pop())
        while pieces and cut + 3 > len(text):
            cut -= len(pieces.pop())
        out += [pieces] if pieces else []
        rest = text[cut:]
        if len(rest) > 4 * self.window:
            head = byte_pieces(rest, self.merges.classes)
            if len(head) == 1:  # one piece without an end so far
                self.open = PieceStream(self.merges, self.window)
                self.open_class = int(self.merges.classes(points_of(rest[1:2]))[0])
                keep = 1 if self.open_class == SPACE else 0
                out += self._plain(self.open.feed(rest[:len(rest) - keep].encode("utf-8", "surrogatepass")))
                rest = rest[len(rest) - keep:]
        return out, rest

    def runs(self, chunk: str, last: bool) -> list[Run]:
        """What is stable once `chunk` is read."""
        text = self.held + chunk
        out: list[Run] = []
        while self.merges.special:
            found = min(((i, s) for s in self.merges.special if (i := text.find(s)) >= 0), default=None)
            if not found:
                break
            done, _ = self._part(text[:found[0]], True)
            out += done + self._plain([self.merges.special[found[1]]])
            text = text[found[0] + len(found[1]):]
        tail = "" if last else self._special_tail(text)
        done, self.held = self._part(text[:len(text) - len(tail)], last)
        self.held += tail
        return out + done

    def _special_tail(self, text: str) -> str:
        """The longest end of `text` that may begin a special string."""
        for n in range(min(self.longest - 1, len(text)), 0, -1):
            if any(s.startswith(text[-n:]) for s in self.merges.special):
                return text[-n:]
        return ""

    def _ids(self, chunk: str, last: bool) -> list[int]:
        return list(chain.from_iterable([e[0] for e in self.pieces.entries([self.runs(chunk, last)])[0]]))

    def feed(self, chunk: str) -> list[int]:
        return self._ids(chunk, False)

    def finish(self) -> list[int]:
        return self._ids("", True)


def encoded(texts: Iterable[str], merges: Merges, pieces: Pieces, chunk: int = 65_536) -> Iterator[tuple[int, list[Entry], bool]]:
    """(number of the text, entries, whether they end it). Short texts are encoded in groups, long ones chunk by chunk."""
    held: list[tuple[int, list[Run]]] = []
    size = 0

    def flush() -> Iterator[tuple[int, list[Entry], bool]]:
        for (k, _), entries in zip(held, pieces.entries([runs for _, runs in held])):
            yield k, entries, True

    for k, text in enumerate(texts):
        encoder = Encoder(merges, pieces.window, pieces)
        if len(text) <= chunk:
            held.append((k, encoder.runs(text, True)))
            size += len(text)
            if size >= GROUP:
                yield from flush()
                held, size = [], 0
            continue
        yield from flush()
        held, size = [], 0
        for at in range(0, len(text), chunk):
            last = at + chunk >= len(text)
            yield k, pieces.entries([encoder.runs(text[at:at + chunk], last)])[0], last
    yield from flush()


class Decoder:
    """Token ids in, text out: bytes that do not yet form a character wait for the next ids."""

    def __init__(self, merges: Merges) -> None:
        self.bytes_of = merges.bytes_of
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        get = self.bytes_of.get
        ids = list(ids)
        try:
            return self.feed_bytes(b"".join(map(get, ids)))
        except TypeError:  # some id is outside the vocabulary
            return self.feed_bytes(b"".join([get(i, b"") for i in ids]))

    def feed_bytes(self, data: bytes) -> str:
        """The same for ids whose bytes are known already."""
        return self.state.decode(data)

    def finish(self) -> str:
        return self.state.decode(b"", True)


@lru_cache(maxsize=4)
def pieces_of(path: str) -> Pieces:
    return Pieces(merges_of(path))


def text_digests(texts: Iterable[str], pieces: Pieces) -> Iterator[tuple[int, str, str]]:
    """Number of tokens, digest of the ids and of the text decoded from them, of each text."""
    start = True
    for _, entries, last in encoded(texts, pieces.merges, pieces):
        if start:
            n, ids_sha, text_sha, decoder = 0, hashlib.sha256(), hashlib.sha256(), Decoder(pieces.merges)
        if entries:
            _, told, data = zip(*entries)
            ids = ",".join(told)
            ids_sha.update((("," if n else "") + ids).encode())
            n += ids.count(",") + 1
            text_sha.update(decoder.feed_bytes(b"".join(data)).encode("utf-8", "replace"))
        start = last
        if last:
            text_sha.update(decoder.finish().encode("utf-8", "replace"))
            yield n, ids_sha.hexdigest(), text_sha.hexdigest()


def digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode each text, decode its ids: doc_id, n_tokens, ids_sha256, decoded_sha256, one row per input row.

    Null and empty texts have 0 tokens and the digest of nothing. Rows are never compared, so ties and repeated rows stay.
    A null doc_id stays null.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path)
        for batch in batches:
            found = list(text_digests((t.as_py() for t in batch.column(1)), pieces))
            n, ids, decoded = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the token ids of each text as an array; a null or empty text gives an empty array."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path)
        for batch in batches:
            found: list[list[int]] = [[] for _ in range(batch.num_rows)]
            for k, entries, _ in encoded((t.as_py() for t in batch.column(1)), pieces.merges, pieces):
                found[k].extend(chain.from_iterable([e[0] for e in entries]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return rows.mapInArrow(run, schema)


def decode(tokens: DataFrame, path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id and the text of each array of ids; null arrays give empty texts, ids outside the vocabulary give nothing."""
    rows = tokens.select(F.col(doc_id).alias("doc_id"), F.col(ids).cast("array<int>").alias("ids"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = merges_of(path)
        for batch in batches:
            texts = []
            for one in batch.column(1):
                decoder = Decoder(merges)
                texts.append(decoder.feed(one.as_py() or []) + decoder.finish())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.mapInArrow(run, schema)
