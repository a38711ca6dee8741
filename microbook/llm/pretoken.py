"""Pre-tokens by character class, vectorised: the splits of the two public byte-pair patterns without a regular expression."""

from __future__ import annotations

import unicodedata

import numpy as np

LETTER, NUMBER, OTHER, SPACE, UNKNOWN = 0, 1, 2, 3, 4
APOSTROPHE, BLANK = 39, 32
# fixed values: the white space of Unicode, and the endings that follow an apostrophe
WHITE = (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


class Classes:
    """Class of each code point. Those that this Python's Unicode lacks are asked of the library's pre-tokenizer when met."""

    def __init__(self, pre_tokenizer) -> None:
        kinds = {"L": LETTER, "N": NUMBER}
        self.of = np.fromiter(
            (UNKNOWN if (c := unicodedata.category(chr(i))) == "Cn" else kinds.get(c[0], OTHER) for i in range(0x110000)),
            np.uint8, 0x110000)
        self.of[list(WHITE)] = SPACE
        self.pre_tokenizer = pre_tokenizer

    def __call__(self, points: np.ndarray) -> np.ndarray:
        found = self.of[points]
        if (found == UNKNOWN).any():
            for point in np.unique(points[found == UNKNOWN]).tolist():
                spans = [span for _, span in self.pre_tokenizer.pre_tokenize_str(f"a{chr(point)}!")]
                self.of[point] = LETTER if (0, 2) in spans else NUMBER if (1, 2) in spans else OTHER
            found = self.of[points]
        return found


def points_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _endings(text: str, starts: np.ndarray, runs: np.ndarray, points: np.ndarray, attached: np.ndarray | None) -> None:
    """Mark the piece after each apostrophe ending: a run that is one apostrophe, with no blank before it in its piece."""
    alone = np.flatnonzero(points == APOSTROPHE)
    if not alone.size:
        return
    for i in alone.tolist():
        if not runs[i] or i + 1 >= len(points) or not runs[i + 1] or (attached is not None and i and attached[i]):
            continue
        for ending in ENDINGS:
            if text.startswith(ending, i + 1):
                starts[i + 1] = False
                if i + 1 + len(ending) < len(points):
                    starts[i + 1 + len(ending)] = True
                break


def byte_pieces(text: str, classes: Classes) -> list[str]:
    """Pieces of the byte-level pattern: a run of letters, numbers or other signs with one blank before it, endings, white space.

    They tile the text. White space gives its last blank to the run that follows; at the end of the text it is one piece.
    """
    if not text:
        return []
    points = points_of(text)
    kind = classes(points)
    runs = np.empty(len(points), bool)
    runs[0] = True
    np.not_equal(kind[1:], kind[:-1], out=runs[1:])
    starts = runs.copy()
    attached = np.zeros(len(points), bool)
    # a run after one blank starts at that blank; the last of several spaces always starts a piece
    attached[1:] = runs[1:] & (points[:-1] == BLANK)
    starts[attached] = False
    starts[:-1] |= runs[1:] & (kind[:-1] == SPACE)
    _endings(text, starts, runs, points, attached)
    cuts = np.flatnonzero(starts).tolist()
    return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)])]


def word_pieces(text: str, classes: Classes) -> list[str]:
    """Pieces of the word pattern: endings, runs of letters, single numbers, runs of other signs; white space is dropped."""
    if not text:
        return []
    points = points_of(text)
    kind = classes(points)
    runs = np.empty(len(points), bool)
    runs[0] = True
    np.not_equal(kind[1:], kind[:-1], out=runs[1:])
    starts = runs | (kind == NUMBER)
    _endings(text, starts, runs, points, None)
    first = np.flatnonzero(starts)
    last = np.append(first[1:], len(text))
    keep = kind[first] != SPACE
    return [text[a:b] for a, b in zip(first[keep].tolist(), last[keep].tolist())]
