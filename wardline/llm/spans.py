"""Substring dedup: windows that an earlier document holds too, found behind a count-min sketch.

Texts are kept in chunks of some megabytes. Every chunk counts its windows in a sketch; the sketches,
cut into ranges of counters, are merged by range, and each chunk gets back which of its own counters
reached two. Only windows whose counters all did go on to exact grouping by 96-bit fingerprint, again in
hash ranges that each hold one entry for a window and chunk. Counters can only be too high, so no repeated
window is lost; at any size a range is of bounded size and nothing is broadcast.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.words import SLICE_BYTES, WordHasher, slices, window_hashes
from wardline.session import staged

CHUNK_BYTES = 4 << 20
#: Bytes of text whose windows share a range of counters, and counters of a range.
RANGE_BYTES, RANGE_BITS = 8 << 20, 23
DEPTH = 2
_LAST = np.iinfo(np.int64).max  # stands for a null key: no document comes after it


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays one after the other, each as planes of bytes, compressed."""
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.dtype.itemsize).T.tobytes() for a in arrays]
    return zstandard.compress(len(arrays[0]).to_bytes(8, "little") + b"".join(planes), 1)


def _unpack(blob: bytes, *types) -> list[np.ndarray]:
    raw = zstandard.decompress(blob)
    n, at, out = int.from_bytes(raw[:8], "little"), 8, []
    for t in types:
        width = np.dtype(t).itemsize
        out.append(np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T.copy().view(t).reshape(-1))
        at += n * width
    return out


def _chunk_rows(batches):
    """Consecutive rows in chunks: keys, which of them are null, text sizes, and the texts compressed."""
    part, number = TaskContext.get().partitionId(), 0
    names = ["chunk", "keys", "known", "sizes", "blob"]
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        keys = batch.column(0)
        for i, j, data, offsets in slices(batch.column(1), CHUNK_BYTES):
            some = keys.slice(i, j - i)
            yield pa.RecordBatch.from_arrays([
                pa.array([part << 32 | number], pa.int64()), pa.array([some.fill_null(_LAST)], pa.list_(pa.int64())),
                pa.array([some.is_valid()], pa.list_(pa.bool_())), pa.array([np.diff(offsets)], pa.list_(pa.int64())),
                pa.array([packer.compress(data.tobytes())], pa.large_binary()).cast(pa.binary())], names)
            number += 1


class _Windows:
    """The windows of one chunk: row and first word of each, two fingerprints, and the words themselves."""

    def __init__(self, size: int):
        self.size, self.one, self.two = size, WordHasher(21), WordHasher(22)

    def read(self, sizes: list[int], blob: bytes, second: bool):
        data = np.frombuffer(zstandard.decompress(blob, max_output_size=max(1, sum(sizes))), np.uint8)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        at = 0
        while at < len(sizes):  # a slice of rows at a time
            to = max(int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1, at + 1)
            part, ends = data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
            words = self.one.words(part, ends)
            first, h = window_hashes(words, self.size)
            g = window_hashes(words._replace(hash=self.two.words(part, ends).hash), self.size, 2)[1] if second else None
            yield at, to, part, words, first, h, g
            at = to


def _counters(h: np.ndarray, row: int, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Range and counter within it; each row of counters reads its own bits of the fingerprint."""
    h = (h >> np.uint64(29 * row)) * np.uint64(0x9E3779B97F4A7C15 + 2 * row)
    return ((h >> np.uint64(40)) * np.uint64(ranges) >> np.uint64(24)).astype(np.int64), (h >> np.uint64(8)).astype(np.uint32) & np.uint32((1 << RANGE_BITS) - 1)


def _sketch(size: int, ranges: int, depth: int):
    def run(batches):
        windows = _Windows(size)
        for batch in batches:
            for chunk, sizes, blob in zip(*(batch.column(c).to_pylist() for c in ("chunk", "sizes", "blob"))):
                h = np.concatenate([np.zeros(0, np.uint64), *[x[5] for x in windows.read(sizes, blob, False)]])
                out: list[list] = [[], [], []]
                for row in range(depth):
                    of, counter = _counters(h, row, ranges)
                    places, counts = np.unique(of.astype(np.uint64) << np.uint64(32) | counter, return_counts=True)
                    ends = np.searchsorted(places >> np.uint64(32), np.arange(ranges + 1))
                    for r in np.flatnonzero(np.diff(ends)):
                        some = places[ends[r] : ends[r + 1]].astype(np.uint32)
                        out[0].append(row * ranges + int(r))
                        out[1].append(chunk)
                        out[2].append(_pack(np.diff(some, prepend=np.uint32(0)), np.minimum(counts[ends[r] : ends[r + 1]], 2).astype(np.uint8)))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.binary()))], ["range", "chunk", "counts"])
    return run


def _merge(table: pa.Table) -> pa.Table:
    """Sums a range's counters over the chunks and tells each chunk which of its own reached two."""
    total = np.zeros(1 << RANGE_BITS, np.uint8)
    read = []
    for blob in table["counts"].to_pylist():
        gaps, counts = _unpack(blob, np.uint32, np.uint8)
        places = np.cumsum(gaps, dtype=np.uint32)
        total[places] = np.minimum(total[places] + counts, 2)
        read.append(places)
    chunks, blobs = [], []
    for chunk, places in zip(table["chunk"].to_pylist(), read):
        found = places[total[places] >= 2]
        if len(found):
            chunks.append(chunk)
            blobs.append(_pack(np.diff(found, prepend=np.uint32(0))))
    return pa.table({"chunk": pa.array(chunks, pa.int64()), "range": pa.array([table["range"][0].as_py()] * len(chunks), pa.int64()),
                     "found": pa.array(blobs, pa.binary())})


def _repeated(size: int, ranges: int, depth: int):
    """A chunk's windows whose counters all reached two, each once: fingerprints, first key, and whether the
    chunk has another key for it."""
    def run(batches):
        windows = _Windows(size)
        for batch in batches:
            for chunk, keys, sizes, blob, found in zip(*(batch.column(c).to_pylist() for c in ("chunk", "keys", "sizes", "blob", "found"))):
                if not found:
                    continue
                marked = [np.zeros(0, np.uint64)] * depth
                for row in range(depth):
                    marked[row] = np.concatenate([marked[row]] + [
                        np.cumsum(_unpack(x["found"], np.uint32)[0], dtype=np.uint32).astype(np.uint64) | np.uint64(x["range"] - row * ranges) << np.uint64(32)
                        for x in found if x["range"] // ranges == row])
                    marked[row].sort()
                hs, gs, ds = [], [], []
                for at, _, _, words, first, h, g in windows.read(sizes, blob, True):
                    keep = np.ones(len(h), bool)
                    for row in range(depth):
                        of, counter = _counters(h, row, ranges)
                        place = of.astype(np.uint64) << np.uint64(32) | counter
                        k = np.minimum(np.searchsorted(marked[row], place), len(marked[row]) - 1)
                        keep &= marked[row][k] == place if len(marked[row]) else False
                    hs.append(h[keep])
                    gs.append(g[keep].astype(np.uint32))
                    ds.append(np.asarray(keys, np.int64)[at + words.doc[first[keep]]])
                h, g, d = map(np.concatenate, (hs, gs, ds))
                order = np.lexsort((d, g, h))
                h, g, d = h[order], g[order], d[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
                starts = np.flatnonzero(new)
                if not len(starts):
                    continue
                last = np.append(starts[1:], len(h)) - 1
                several = d[last] > d[starts]
                h, g, d = h[starts], g[starts], d[starts]
                ends = np.searchsorted((h >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32), np.arange(ranges + 1))
                out: list[list] = [[], [], []]
                for r in np.flatnonzero(np.diff(ends)):
                    s = slice(ends[r], ends[r + 1])
                    out[0].append(int(r))
                    out[1].append(chunk)
                    out[2].append(_pack(h[s], g[s], d[s], several[s]))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.binary()))], ["range", "chunk", "windows"])
    return run


def _exact(table: pa.Table) -> pa.Table:
    """The first key of every window of a range; each chunk gets those of its windows that an earlier key has."""
    blobs = [_unpack(b, np.uint64, np.uint32, np.int64, np.bool_) for b in table["windows"].to_pylist()]
    h, g, d, several = (np.concatenate(x) for x in zip(*blobs))
    owner = np.repeat(np.arange(len(blobs)), [len(b[0]) for b in blobs])
    order = np.lexsort((g, h))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1])
    starts = np.flatnonzero(new)
    least = np.empty(len(h), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(d[order], starts), np.diff(np.append(starts, len(h))))
    late = (least < d) | several
    chunks, out = [], []
    names = table["chunk"].to_pylist()
    bounds = np.concatenate([[0], np.cumsum([len(b[0]) for b in blobs])])
    for k in range(len(blobs)):
        m = np.flatnonzero(late[bounds[k] : bounds[k + 1]]) + bounds[k]
        if len(m):
            chunks.append(names[k])
            out.append(_pack(h[m], least[m]))
    return pa.table({"chunk": pa.array(chunks, pa.int64()), "late": pa.array(out, pa.binary())})


def _removed(size: int, with_text: bool):
    def run(batches):
        windows = _Windows(size)
        for batch in batches:
            for keys, known, sizes, blob, late in zip(*(batch.column(c).to_pylist() for c in ("keys", "known", "sizes", "blob", "late"))):
                parts = [_unpack(x, np.uint64, np.int64) for x in late or []]
                h0, least = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
                order = np.argsort(h0, kind="stable")
                h0, least = h0[order], least[order]
                out: list[list] = [[], [], [], [], []]
                for at, to, data, words, first, h, g in windows.read(sizes, blob, False):
                    covered = np.zeros(len(words.hash) + 1, np.int64)
                    if len(h0):
                        # Within a chunk the first fingerprint, of 64 bits, names a window.
                        k = np.minimum(np.searchsorted(h0, h), len(h0) - 1)
                        hit = (h0[k] == h) & (least[k] < np.asarray(keys, np.int64)[at + words.doc[first]])
                        np.add.at(covered, first[hit], 1)
                        np.add.at(covered, first[hit] + size, -1)
                    gone = np.cumsum(covered[:-1]) > 0
                    counts = np.bincount(words.doc, minlength=to - at)
                    removed = np.bincount(words.doc[gone], minlength=to - at)
                    raw, by_row = data.tobytes(), np.concatenate([[0], np.cumsum(counts)])
                    for r in range(to - at):
                        a, b = by_row[r], by_row[r + 1]
                        stay = np.flatnonzero(~gone[a:b]) + a
                        text = b" ".join(raw[s:e] for s, e in zip(words.start[stay].tolist(), words.stop[stay].tolist()))
                        for column, value in zip(out, (keys[at + r] if known[at + r] else None, int(counts[r]), int(removed[r]),
                                                       hashlib.sha256(text).hexdigest(), text.decode() if with_text else None)):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()))],
                                                 ["key", "n_words", "n_removed", "kept_sha256", "kept"])
    return run


def without_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 13, depth: int = DEPTH,
                    with_text: bool = True) -> DataFrame:
    """``(key, n_words, n_removed, kept_sha256, kept)`` of every row: its text without repeated passages.

    A word goes when a window of ``size`` words that covers it also starts in a row with a smaller key;
    ``kept`` joins the others by one space (null unless ``with_text``). Windows are judged on the input.
    Null and empty texts have no words. Rows that repeat a key never take from each other; a null key is
    larger than all others. Other columns are not read.
    """
    chunks = staged(df.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text")).mapInArrow(
        _chunk_rows, "chunk bigint, keys array<bigint>, known array<boolean>, sizes array<bigint>, blob binary"), "chunks")
    total = chunks.select(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, b: a + b))).first()[0] or 0
    ranges = max(1, -(-total // RANGE_BYTES))
    found = (chunks.select("chunk", "sizes", "blob").mapInArrow(_sketch(size, ranges, depth), "range bigint, chunk bigint, counts binary")
             .groupBy("range").applyInArrow(_merge, "chunk bigint, range bigint, found binary"))
    found = found.groupBy("chunk").agg(F.collect_list(F.struct("range", "found")).alias("found"))
    # Both joins deal the chunks out alike, so Spark moves them once.
    late = (chunks.join(found, "chunk", "left").select("chunk", "keys", "known", "sizes", "blob", "found")
            .mapInArrow(_repeated(size, ranges, depth), "range bigint, chunk bigint, windows binary")
            .groupBy("range").applyInArrow(_exact, "chunk bigint, late binary"))
    late = late.groupBy("chunk").agg(F.collect_list("late").alias("late"))
    out = chunks.join(late, "chunk", "left").select("chunk", "keys", "known", "sizes", "blob", "late").mapInArrow(
        _removed(size, with_text), "key bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string")
    return out.withColumnRenamed("key", key)
