"""Words and lines of many texts at once, as arrays over their joined UTF-8 bytes.

Only ASCII bytes separate words or lines, so nothing needs to be decoded. Words are told apart by a
64-bit polynomial hash, taken from prefix sums: a word costs two lookups. Strings of a thousand letters and more
can be built that share such a hash for every multiplier, so long words and lines are hashed by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import xxhash

#: Bytes up to which a range is told apart by its polynomial hash; known collisions need four times as many.
LONG_RANGE = 256

#: Bytes of a text whose hash sums are taken at a time.
SLICE = 1 << 18

#: Odd multiplier of the polynomial hash and its inverse modulo 2**64 (fixed values).
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64, at least ``n`` of them."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        grown = np.full(size, base, np.uint64)
        grown[0] = 1
        have = _POWERS[base] = np.multiply.accumulate(grown)
    return have[:n]


def powers_at(base: int, at: np.ndarray) -> np.ndarray:
    """base**i modulo 2**64 for every i in ``at``, from two short tables whatever the size of i."""
    most = int(at.max(initial=0)) >> 16
    high = powers(pow(base, 1 << 16, 1 << 64), most + 1)
    return powers(base, 1 << 16)[at & 0xFFFF] * high[at >> 16]


def mix(values: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every bit of the result depends on every bit of the value."""
    x = values ^ (values >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def per_text(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive cuts; empty stretches give zero."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[cuts[1:]] - sums[cuts[:-1]]


class Scan:
    """Texts joined by line breaks: ``text_at`` cuts the bytes, ``word_at`` the words, ``line_at`` the lines."""

    def __init__(self, texts: list[str]):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        self.data = b"\n".join([*raw, b""]) if raw else b""
        self.bytes = np.frombuffer(self.data, np.uint8)
        lengths = np.fromiter(map(len, raw), np.int64, len(raw)) + 1
        self.text_at = np.concatenate([[0], np.cumsum(lengths)])
        n = len(self.bytes)
        self._prefix = np.zeros(n + 1, np.uint64)
        # Slice by slice, so that a very long text needs the sums and little else.
        for a in range(0, n, SLICE):
            part = self.bytes[a : a + SLICE].astype(np.uint64)
            part += np.uint64(1)
            part *= powers(BASE, len(part))
            part *= np.uint64(pow(BASE, a, 1 << 64))
            part[:1] += self._prefix[a : a + 1]
            np.cumsum(part, out=self._prefix[a + 1 : a + 1 + len(part)])
        blank = np.ones(n + 1, bool)
        blank[1:] = _SPACE[self.bytes]
        # A text ends with a line break, so words start and end in turn.
        edges = np.flatnonzero(blank[1:] != blank[:-1])
        self.word_start, self.word_end = edges[0::2], edges[1::2]
        self.word_at = np.searchsorted(self.word_start, self.text_at)
        self.line_end = np.flatnonzero(self.bytes == 0x0A)
        self.line_start = np.concatenate([[0], self.line_end[:-1] + 1]) if n else self.line_end
        self.line_at = np.searchsorted(self.line_start, self.text_at)

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of every byte range [start, end)."""
        inner = self._prefix[end] - self._prefix[start]
        out = mix(inner * powers_at(INVERSE, start) + (end - start).astype(np.uint64))
        for i in np.flatnonzero(end - start > LONG_RANGE):
            out[i] = xxhash.xxh3_64_intdigest(self.data[start[i] : end[i]])
        return out

    @property
    def word_hash(self) -> np.ndarray:
        return self.hashes(self.word_start, self.word_end)

    def count(self, table: np.ndarray) -> np.ndarray:
        """Bytes per text whose entry in a table of 256 booleans is set."""
        return per_text(table[self.bytes], self.text_at)

    def code_points(self) -> np.ndarray:
        """Whether a byte begins a code point."""
        return (self.bytes & 0xC0) != 0x80


def windows(hashes: np.ndarray, cuts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every run of ``width`` words that lies within one text."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    rolled = np.zeros(n, np.uint64)
    for k in range(width):
        rolled = rolled * np.uint64(BASE) + hashes[k : k + n]
    left = np.repeat(cuts[1:], np.diff(cuts))[:n] - np.arange(n)
    first = np.flatnonzero(left >= width)
    return first, mix(rolled[first])


def repeated(owner: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether (owner, key) occurs more than once, and whether it occurred at an earlier place."""
    order = np.lexsort((np.arange(len(keys)), keys, owner))
    same = np.zeros(len(keys), bool)
    later = np.zeros(len(keys), bool)
    if len(keys) > 1:
        equal = (keys[order[1:]] == keys[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
        later[order[1:]] = equal
        same[order[1:]] |= equal
        same[order[:-1]] |= equal
    return same, later


def owners(cuts: np.ndarray) -> np.ndarray:
    """Number of the text of every element."""
    return np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))


class Base:
    """Surface counts of every text of a scan, one array each."""

    SYMBOLS = "#*$%&|<>"
    WINDOW = 5

    def __init__(self, scan: Scan):
        self.n_words = np.diff(scan.word_at)
        marks = np.zeros(256, bool)
        marks[[ord(c) for c in self.SYMBOLS]] = True
        self.n_symbols = scan.count(marks)
        points = np.concatenate([[0], np.cumsum(scan.code_points(), dtype=np.int64)])
        self.word_chars = per_text(points[scan.word_end] - points[scan.word_start], scan.word_at)
        # Lines that hold a word, equal to an earlier line of the text.
        wordy = np.searchsorted(scan.word_start, scan.line_end) > np.searchsorted(scan.word_start, scan.line_start)
        at = np.flatnonzero(wordy)
        line_owner = owners(scan.line_at)
        _, later = repeated(line_owner[at], scan.hashes(scan.line_start[at], scan.line_end[at]))
        self.n_dup_lines = np.bincount(line_owner[at][later], minlength=len(self.n_words))
        # Words inside any window of five that occurs twice or more in the text.
        self.word_hash = scan.word_hash
        first, keys = windows(self.word_hash, scan.word_at, self.WINDOW)
        same, _ = repeated(owners(scan.word_at)[first], keys)
        cover = np.zeros(len(self.word_hash) + 1, np.int64)
        np.add.at(cover, first[same], 1)
        np.add.at(cover, first[same] + self.WINDOW, -1)
        self.n_repeat_words = per_text(np.cumsum(cover)[:-1] > 0, scan.word_at)


def scans(texts: Iterable, size: int = 1 << 18) -> Iterator[tuple[int, Scan]]:
    """(number of texts, scan) for consecutive runs of texts of bounded size."""
    from .bpe import text_blocks

    for block in text_blocks(texts, size):
        yield len(block), Scan(block)
