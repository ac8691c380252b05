"""Best-fit packing with large-item matching.

Only the number of pieces of each length matters for who shares a sequence, and lengths end at the
capacity, so the plan is made from a histogram and is of bounded size at any input. It says, for the
pieces of a length in order, which sequence and offset the next so many take; pieces find their places by
their rank within their length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardline.llm.tokens import forget_tokens, tokens_of
from wardline.session import staged

_FIELDS = ("key bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids array<int>, part bigint, rank bigint")


def _pieces(path: str, end: int, capacity: int, with_ids: bool, keep_words: bool = True):
    def run(batches):
        part, ranks = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for first, ids, offsets in tokens_of(path, True).encode(batch.column(1)):
                n = len(offsets) - 1
                ids, offsets = np.insert(ids, offsets[1:], np.uint32(end)), offsets + np.arange(n + 1)
                sizes = np.diff(offsets)
                counts = -(-sizes // capacity)
                row = np.repeat(np.arange(n), counts)
                piece = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                # Whole pieces end the document; what is left over comes first.
                head = sizes[row] - (counts[row] - 1) * capacity
                start = np.where(piece == 0, 0, head + (piece - 1) * capacity)
                length = np.where(piece == 0, head, capacity)
                view = memoryview(ids.tobytes())
                a = offsets[row] + start
                crc = [zlib.crc32(view[4 * x : 4 * y]) for x, y in zip(a.tolist(), (a + length).tolist())]
                order = np.argsort(length, kind="stable")
                found, begin = np.unique(length[order], return_index=True)
                within = np.empty(len(length), np.int64)
                within[order] = np.arange(len(length)) - np.repeat(begin, np.diff(np.append(begin, len(length))))
                rank = ranks[length] + within
                ranks[found] += np.diff(np.append(begin, len(length)))
                lists = [ids[x:y].astype(np.int32) for x, y in zip(a, a + length)] if with_ids else [None] * len(row)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, n).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length),
                    pa.array(crc, pa.int64()), pa.array(lists, pa.list_(pa.int32())), pa.array(np.full(len(row), part)), pa.array(rank)],
                    [f.split()[0] for f in _FIELDS.split(", ")])
        if not keep_words:
            forget_tokens()
    return run


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """``(length, first rank, sequences, first sequence, offset)``: places for the pieces of each length.

    Pieces above a third of the capacity go first: the longest left is matched with the longest that
    still fits beside it, so a sequence holds two of them at most. Shorter ones, longest first, fill the
    smallest gap that takes them, or begin a new sequence. Equal sequences are planned together.
    """
    left = {s: n for s, n in counts.items() if n > 0}
    places, taken, sequences = [], defaultdict(int), 0
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap: (first sequence, sequences)

    def put(length, first, n, offset):
        places.append((length, taken[length], n, first, offset))
        taken[length] += n
        left[length] -= n

    large = sorted((s for s in left if 3 * s > capacity), reverse=True)
    for s in large:
        while left[s]:
            mate = next((x for x in large if x <= min(s, capacity - s) and left[x] and (x != s or left[x] > 1)), None)
            n = left[s] if mate is None else left[s] // 2 if mate == s else min(left[s], left[mate])
            put(s, sequences, n, 0)
            if mate is not None:
                put(mate, sequences, n, s)
            gaps[capacity - s - (mate or 0)].append((sequences, n))
            sequences += n
    for s in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        while left[s]:
            gap = next((g for g in range(s, capacity + 1) if gaps.get(g)), None)
            if gap is None:
                each = capacity // s
                n = max(1, left[s] // each)
                gap = capacity
                gaps[gap].append((sequences, n))
                sequences += n
            first, n = gaps[gap].pop()
            used = min(n, left[s])
            put(s, first, used, capacity - gap)
            gaps[gap - s].append((first, used))
            if used < n:
                gaps[gap].append((first + used, n - used))
    return sorted(places)


def pack(df: DataFrame, tokenizer: str, end: int, capacity: int = 1024, key: str = "doc_id", text: str = "text",
         with_ids: bool = True, keep_words: bool = True) -> DataFrame:
    """``(key, piece, start, length, ids_crc32, ids, sequence_id, offset)`` of every piece of every row.

    A text's ids and the id ``end`` are one piece; longer ones are cut into pieces of ``capacity``, of which the
    first may be shorter. Null and empty texts are the end id alone. Rows that repeat a key, and rows with
    a null key, are packed like any other. ``ids`` is null unless asked for. Other columns are not read.
    A worker keeps the tokenizer and the words it has met for its next task, unless ``keep_words`` is off: then other work of the
    same workers has that memory.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    pieces = staged(rows.mapInArrow(_pieces(tokenizer, end, capacity, with_ids, keep_words), _FIELDS), "pieces")
    by_part = staged(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "lengths")
    # A row for each part of a length: as many as the tasks that made the pieces.
    before = by_part.select("length", "part", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # one row a length
    places = plan(counts, capacity)
    table = [np.array(x, np.int64) for x in zip(*places)] if places else [np.zeros(0, np.int64)] * 5
    name = table[0] << 44 | table[1]

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            k = np.searchsorted(name, length << 44 | rank, "right") - 1
            keep = [batch.column(c) for c in ("key", "piece", "start", "length", "ids_crc32", "ids")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(table[3][k] + rank - table[1][k]), pa.array(table[4][k])],
                                             ["key", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"])

    ranked = pieces.join(before, ["length", "part"]).withColumn("rank", F.col("rank") + F.col("before"))
    return ranked.mapInArrow(place, "key bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids array<int>, "
                             "sequence_id bigint, offset bigint").withColumnRenamed("key", key)
