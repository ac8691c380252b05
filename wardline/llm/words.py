"""Word and window fingerprints of Arrow text columns, computed on whole buffers with numpy.

A word is a run of bytes other than space and U+0009 to U+000D. A word's hash is a polynomial
over random byte values modulo 2**64, taken from prefix sums, so no Python code runs per word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Words(NamedTuple):
    doc: np.ndarray    # row within the slice
    start: np.ndarray  # byte offsets within the slice
    stop: np.ndarray
    hash: np.ndarray


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (splitmix64's finisher)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def byte_values(seed: int, fold: bool) -> np.ndarray:
    table = np.random.default_rng(seed).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    if fold:
        table[65:91] = table[97:123]
    return table


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class WordHasher:
    """Hashes the words of byte slices; ``fold`` treats A-Z as a-z."""

    def __init__(self, seed: int = 1, fold: bool = False):
        self.table = byte_values(seed, fold)
        self.base = int(0xD6E8FEB86659FD93 + 2 * seed) | 1
        self.inverse = pow(self.base, -1, 2**64)
        self.size = 0

    def _ready(self, n: int) -> None:
        if n > self.size:
            self.size = max(n, SLICE_BYTES + 1)
            self.up, self.down = _powers(self.base, self.size), _powers(self.inverse, self.size)

    def bounds(self, data: np.ndarray, offsets: np.ndarray, cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        inside = ~_SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        if cuts is not None:
            edge[1:-1] |= cuts
        starts = inside.copy()
        starts[1:] &= ~inside[:-1] | edge[1:-1]
        stops = inside.copy()
        stops[:-1] &= ~inside[1:] | edge[1:-1]
        return np.flatnonzero(starts), np.flatnonzero(stops) + 1

    def words(self, data: np.ndarray, offsets: np.ndarray, cuts: np.ndarray | None = None) -> Words:
        """``data``: the bytes of the rows one after the other; ``offsets``: where rows begin, and the end;
        ``cuts``: whether a word ends between a byte and the next, too."""
        start, stop = self.bounds(data, offsets, cuts)
        hashes = np.empty(len(start), np.uint64)
        i = 0
        while i < len(start):  # blocks of whole words, so that powers stay short for any text
            j = max(int(np.searchsorted(stop, start[i] + SLICE_BYTES, "right")), i + 1)
            a, b = start[i], stop[j - 1]
            self._ready(int(b - a) + 1)
            sums = np.zeros(b - a + 1, np.uint64)
            np.cumsum(self.table[data[a:b]] * self.up[: b - a], out=sums[1:])
            s = start[i:j] - a
            hashes[i:j] = (sums[stop[i:j] - a] - sums[s]) * self.down[s]
            i = j
        doc = np.searchsorted(offsets, start, "right") - 1
        return Words(doc, start, stop, mix(hashes))


def window_hashes(words: Words, size: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every run of ``size`` consecutive words of one row."""
    n = len(words.hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    weights = np.random.default_rng(100 + seed).integers(1, 2**63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += words.hash[k : k + n] * weights[k]
    first = np.flatnonzero(words.doc[:n] == words.doc[size - 1 :])
    return first, mix(total[first])


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``[i, j)`` with their bytes and offsets, about ``limit`` bytes each (one row may be longer)."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1, i + 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def cut(text: bytes, gap: re.Pattern, limit: int = SLICE_BYTES) -> Iterator[bytes]:
    """The text in pieces of about ``limit`` bytes, each ending behind a match of ``gap``."""
    at = 0
    while len(text) - at > limit:
        found = gap.search(text, at + limit - 1)
        if not found:
            break
        yield text[at : found.end()]
        at = found.end()
    yield text[at:] if at else text


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
