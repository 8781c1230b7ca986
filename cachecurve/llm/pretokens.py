"""Pre-tokens of the byte-level vocabulary, many texts at a time.

The split is the one the tokenizer file names (``ByteLevel`` with its own pattern): a
contraction, or a run of letters, digits or other signs with at most one blank before it,
or white space. Boundaries depend only on the class of a character and its neighbours, so
numpy finds them for a whole batch; a test compares the result with the tokenizers library
over every code point. Texts that the tables here cannot promise to split alike (special
strings, code points newer than Python's Unicode) are left to the library as a whole.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np

SPACE, LETTER, DIGIT, OTHER, UNKNOWN, END = range(6)
#: Stands between texts; no text holds it because Arrow strings are valid UTF-8.
SEPARATOR = "\ud800"
#: Fixed values of the split: contractions by the letters after the apostrophe.
SHORT_TAILS = "stmd"
LONG_TAILS = ("re", "ve", "ll")
#: White space of the split beyond the separator categories of Unicode.
CONTROL_SPACES = "\t\n\x0b\x0c\r\x85"
#: A place where every split has a boundary: one blank between two other signs.
SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Characters that are split at a time. Their arrays take about 60 bytes a character, and the powers that
#: a worker process keeps 32 more.
BATCH_CHARS = 1 << 20
#: Odd, so that its powers have inverses modulo 2**64.
BASE = 0x9E3779B97F4A7C15


@functools.cache
def char_classes() -> np.ndarray:
    """Class of every code point, from the general category."""
    kinds = {"L": LETTER, "N": DIGIT, "Z": SPACE}
    names = [unicodedata.category(chr(c)) for c in range(0x110000)]
    table = np.fromiter((UNKNOWN if k == "Cn" else kinds.get(k[0], OTHER) for k in names),
                        np.uint8, 0x110000)
    table[[ord(c) for c in CONTROL_SPACES]] = SPACE
    table[ord(SEPARATOR)] = END
    return table


@functools.cache
def _powers(n: int = 2 * BATCH_CHARS) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    up, down = np.full(n, BASE, np.uint64), np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def segments(text: str, most: int = BATCH_CHARS) -> Iterator[str]:
    """A long text in parts that split into the same pre-tokens; rarely longer than ``most``."""
    start = 0
    while len(text) - start > most:
        cut = SAFE_CUT.search(text, start + most)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:] if start else text


class Pieces:
    """The pre-tokens of a list of texts: distinct ones by a 64-bit hash, and where they stand.

    ``inverse`` has for each pre-token, in order, its place among the distinct ones, and
    ``counts`` how many pre-tokens each text has. ``odd`` marks texts with code points of
    unknown class, whose pre-tokens may differ from the library's.
    """

    def __init__(self, texts: list[str]):
        self.joined = SEPARATOR.join(texts) + SEPARATOR
        codes = np.frombuffer(self.joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = char_classes()[codes]
        ends = np.flatnonzero(kind == END)
        self.odd = np.diff(np.searchsorted(np.flatnonzero(kind == UNKNOWN), ends), prepend=0) > 0
        edges, begin = self._edges(codes, kind)
        opens = begin[edges]
        self.starts = edges[opens]
        self.stops = edges[1:][opens[:-1]]
        self.counts = np.diff(np.searchsorted(self.starts, ends), prepend=0)
        # one table is kept for all batches; the rare longer text has its own
        up, down = _powers() if len(codes) <= 2 * BATCH_CHARS else _powers.__wrapped__(len(codes))
        mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(29)
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(mixed * up[:len(codes)], out=sums[1:])
        hashes = (sums[self.stops] - sums[self.starts]) * down[self.starts]
        self.hashes, self.first, self.inverse = np.unique(
            hashes, return_index=True, return_inverse=True)

    def _edges(self, codes: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where pre-tokens begin or texts end, and a mask of the former."""
        edge = np.array([END], np.uint8)
        before, after = np.concatenate((edge, kind[:-1])), np.concatenate((kind[1:], edge))
        space = kind == SPACE
        word = ~space & (kind != END)
        begin = (kind != before) & word
        # the last white space before a word: a blank joins the word, another sign stands alone
        last = space & (after != SPACE) & (after != END)
        begin[1:] &= ~(last & (codes == 0x20))[:-1]
        begin |= last | (space & (before != SPACE))
        # a contraction starts where a run of other signs starts, with no blank before it
        for at in np.flatnonzero((codes == 0x27) & begin & (after == LETTER)).tolist():
            tail = self.joined[at + 1:at + 3]
            cut = 2 if tail[0] in SHORT_TAILS else 3 if tail in LONG_TAILS else 0
            if cut:
                begin[at + 1] = False
                begin[at + cut] |= word[at + cut]
        return np.flatnonzero(begin | (kind == END)), begin

    def text(self, k: int) -> str:
        """The distinct pre-token ``k``."""
        i = self.first[k]
        return self.joined[self.starts[i]:self.stops[i]]


def piece_batches(texts: list[str], most: int = BATCH_CHARS) -> Iterator[tuple[int, int, list[str]]]:
    """Ranges of neighbouring texts with about ``most`` characters, and those texts."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield first, i, texts[first:i]
            first, size = i, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, len(texts), texts[first:]


class PieceCache:
    """Values of pre-tokens by hash, in two generations: when the young one fills up it
    becomes the old one, and what the old one held unused is dropped."""

    def __init__(self, kept: dict[int, object], compute: Callable[[list[str]], list],
                 most: int = 1_000_000):
        self.kept, self.compute, self.most = kept, compute, most
        self.young, self.old = dict(kept), {}

    def of(self, pieces: Pieces) -> list:
        keys = pieces.hashes.tolist()
        found = list(map(self.young.get, keys, repeat(None)))
        missing = [k for k, v in enumerate(found) if v is None]
        if len(self.young) + len(missing) > self.most // 2:
            self.young, self.old = dict(self.kept), self.young
        unknown = []
        for k in missing:
            value = self.old.get(keys[k])
            if value is None:
                unknown.append(k)
            else:
                found[k] = self.young[keys[k]] = value
        for k, value in zip(unknown, self.compute([pieces.text(k) for k in unknown])):
            found[k] = self.young[keys[k]] = value
        return found
