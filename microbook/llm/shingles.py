"""Sets of word shingles as sorted 64-bit hashes, vectorised over many texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SLICE = 1 << 20  # bytes hashed at once
U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
PLACE = _rng.integers(0, 1 << 63, 8, dtype=np.uint64) * U(2) + U(1)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every input bit moves every output bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n + 1 of each; only the usual size is kept."""
    size = SLICE if n <= SLICE else n
    if size in _POWERS:
        return _POWERS[size]
    out = []
    for base in (BASE, INVERSE):
        row = np.full(size + 1, base, np.uint64)
        row[0] = 1
        out.append(np.cumprod(row, dtype=np.uint64))
    if size == SLICE:
        _POWERS[size] = (out[0], out[1])
    return out[0], out[1]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of lower-cased bytes: a difference of prefix sums, so any word costs the same."""
    raw = np.frombuffer(data, np.uint8)
    inside = np.empty(len(raw) + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(IS_SPACE[raw], out=inside[1:-1])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[0::2], edge[1::2]
    up, down = _powers(len(raw))
    sums = np.empty(len(raw) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(BYTE[raw] * up[:len(raw)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts]), starts


def windows(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of `width` words; of all words if there are fewer."""
    n = min(width, len(words))
    if not n:
        return words
    total = np.full(len(words) - n + 1, n, np.uint64)
    for j in range(n):
        total = total + words[j:len(words) - n + 1 + j] * PLACE[j]
    return mix(total)


def _long(data: bytes) -> Iterator[bytes]:
    """Parts of a long text, cut at white space."""
    at = 0
    while at < len(data):
        to = min(len(data), at + SLICE)
        while to < len(data) and not IS_SPACE[data[to]]:
            to += 1
        yield data[at:to]
        at = to


def shingle_sets(texts: list[str], width: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, A-Z lower-cased; empty without words. Two shingles are taken as the same
    if their 64-bit hashes are."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        data = text.encode("utf-8", "surrogatepass").translate(LOWER)
        if size + len(data) + 1 > SLICE and held:
            yield from _sets(held, width)
            held, size = [], 0
        if len(data) >= SLICE:
            yield _long_set(data, width)
        else:
            held.append(data)
            size += len(data) + 1
    if held:
        yield from _sets(held, width)


def _sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    words, starts = word_hashes(b"\n".join(texts))
    bounds = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))
    first = 0
    for last in bounds.tolist():
        yield np.unique(windows(words[first:last], width))
        first = last


def _long_set(data: bytes, width: int) -> np.ndarray:
    found, tail = np.empty(0, np.uint64), np.empty(0, np.uint64)
    for part in _long(data):
        words = np.concatenate([tail, word_hashes(part)[0]])
        if len(words) < width:
            tail = words
            continue
        found = np.union1d(found, windows(words, width))
        tail = words[len(words) - width + 1:]
    return found if len(found) else np.unique(windows(tail, width))
