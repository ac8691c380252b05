"""Token ids of a corpus as coded files in key order, and what reads them back.

A file is a table of segments: some millions of ids of consecutive documents as one coded frame, and an
index of the documents in it. Frames are coded and read on their own, so is every block of a frame.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardline.llm.coder import decode, encode
from wardline.llm.tables import small
from wardline.llm.tokens import tokens_of
from wardline.session import work_path

SEGMENT_IDS = 6_000_000
_FIELDS = "part bigint, segment bigint, n_docs bigint, n_ids bigint, documents binary, frame binary"


def _segments(path: str, end: int | None):
    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        keys: list[np.ndarray] = []
        known: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        sizes: list[np.ndarray] = []

        def flush():
            nonlocal number
            all_ids, all_sizes = np.concatenate(ids), np.concatenate(sizes)
            index = np.concatenate(keys).tobytes() + all_sizes.tobytes() + np.packbits(np.concatenate(known)).tobytes()
            row = [part, number, len(all_sizes), len(all_ids), zstandard.compress(index), encode(all_ids)]
            number += 1
            for x in (keys, known, ids, sizes):
                x.clear()
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], [f.split()[0] for f in _FIELDS.split(", ")])

        held = 0
        for batch in batches:
            for first, found, offsets in tokens_of(path, False).encode(batch.column(1)):
                n = len(offsets) - 1
                some = batch.column(0).slice(first, n)
                if end is not None:
                    found = np.insert(found, offsets[1:], np.uint32(end))
                    offsets = offsets + np.arange(n + 1)
                keys.append(some.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
                known.append(some.is_valid().to_numpy(zero_copy_only=False))
                ids.append(found)
                sizes.append(np.diff(offsets))
                held += len(found)
                if held >= SEGMENT_IDS:
                    yield flush()
                    held = 0
        if ids:
            yield flush()
    return run


def write_token_files(df: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text", end: int | None = None) -> None:
    """Writes the ids of every whole text in ascending order of the key to ``path``.

    ``tokenizer``: a file whose ids do not depend on white space; ``end``: an id to append to each
    document. Null is the empty text, null keys come first, and rows that repeat a key follow each other.
    An empty table gives files without segments; other columns are not read.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    (rows.repartitionByRange(parts, F.col("key").asc_nulls_first()).sortWithinPartitions(F.col("key").asc_nulls_first(), "text")
     .mapInArrow(_segments(tokenizer, end), _FIELDS).write.parquet(path))


def _documents(segment: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n, index, frame = segment
    raw = zstandard.decompress(index)
    return (np.frombuffer(raw, np.int64, n), np.frombuffer(raw, np.int64, n, 8 * n),
            np.unpackbits(np.frombuffer(raw, np.uint8, -1, 16 * n), count=n).astype(bool), decode(frame))


def _read(with_ids: bool):
    def run(batches):
        for batch in batches:
            for part, segment, n, index, frame in zip(*(batch.column(c).to_pylist() for c in ("part", "segment", "n_docs", "documents", "frame"))):
                keys, sizes, known, ids = _documents((n, index, frame))
                ends = np.cumsum(sizes)
                begins = ends - sizes
                view = memoryview(ids.tobytes())
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
                lists = [ids[a:b].astype(np.int64) for a, b in zip(begins, ends)] if with_ids else [None] * n
                yield pa.RecordBatch.from_arrays([
                    pa.array([part] * n, pa.int64()), pa.array([segment] * n, pa.int64()), pa.array(keys, mask=~known), pa.array(begins),
                    pa.array(sizes), pa.array(crc, pa.int64()), pa.array(lists, pa.list_(pa.int64()))],
                    ["part", "segment", "key", "begin", "n_tokens", "ids_crc32", "ids"])
    return run


def read_token_files(spark: SparkSession, path: str, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """``(key, start, n_tokens, ids_crc32, ids)`` of every document in the files; ``start`` counts the ids of all
    documents before it. A damaged block stops the read with an error. ``ids`` is null unless asked for."""
    segments = spark.read.schema(_FIELDS).parquet(path)
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))  # a row for each file
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("of_part"))
    place = (segments.select("part", "segment", (F.sum("n_ids").over(Window.partitionBy("part").orderBy("segment")) - F.col("n_ids")).alias("of_segment"))
             .join(before, "part").select("part", "segment", (F.col("of_part") + F.col("of_segment")).alias("offset")))
    docs = segments.select("part", "segment", "n_docs", "documents", "frame").mapInArrow(
        _read(with_ids), "part bigint, segment bigint, key bigint, begin bigint, n_tokens bigint, ids_crc32 bigint, ids array<bigint>")
    # A row a segment, so that decoded documents neither move nor sort.
    return docs.join(small(place), ["part", "segment"]).select(
        F.col("key").alias(key), (F.col("begin") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", "ids")


def token_table(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end: int | None = None, with_ids: bool = False) -> DataFrame:
    """Writes the files to a fresh path under the shared folder and reads them back."""
    path = work_path(df.sparkSession, "tokens")
    write_token_files(df, path, tokenizer, key, text, end)
    return read_token_files(df.sparkSession, path, key, with_ids)
