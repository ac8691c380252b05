"""Exact dedup by chunk recipes.

A text is cut where a rolling hash of its last 32 bytes says so, hence equal texts are cut alike.
Chunks become identifiers once, and documents are compared by their ordered identifier lists; a long
text is read in one scan and never moved.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.words import slices
from wardline.session import staged

LEAST, MEAN_BITS, MOST = 256, 10, 16_384
RECIPE = "struct<sha256:string,chunks:array<struct<digest:binary,size:int,crc:bigint>>>"
_TYPE = pa.struct([("sha256", pa.string()), ("chunks", pa.list_(pa.struct(
    [("digest", pa.binary()), ("size", pa.int32()), ("crc", pa.int64())])))])
_GEAR = np.random.default_rng(32).integers(0, 2**32, 256, dtype=np.uint32)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def cut_points(data: np.ndarray) -> np.ndarray:
    """Ends of bytes where the hash of the 32 bytes before them allows a cut."""
    h = _GEAR[data]
    for k in (1, 2, 4, 8, 16):
        h[k:] += h[:-k] << np.uint32(k)
    return np.flatnonzero(h >> np.uint32(32 - MEAN_BITS) == 0) + 1


def chunk_ends(points: np.ndarray, start: int, stop: int) -> list[int]:
    ends, at, k = [], start, int(np.searchsorted(points, start + LEAST))
    while at < stop:
        while k < len(points) and points[k] < at + LEAST:
            k += 1
        limit = min(at + MOST, stop)
        at = int(points[k]) if k < len(points) and points[k] < limit else limit
        ends.append(at)
    return ends


def recipes(text: pa.Array) -> pa.Array:
    """Digest of every folded text, and its chunks in order."""
    rows = []
    for i, j, data, offsets in slices(text):
        data = _FOLD[data]
        points, raw = cut_points(data), data.tobytes()
        for k in range(j - i):
            start, stop = int(offsets[k]), int(offsets[k + 1])
            chunks, at = [], start
            for end in chunk_ends(points, start, stop):
                piece = raw[at:end]
                chunks.append({"digest": hashlib.blake2b(piece, digest_size=16).digest(), "size": end - at, "crc": zlib.crc32(piece)})
                at = end
            rows.append({"sha256": hashlib.sha256(raw[start:stop]).hexdigest(), "chunks": chunks})
    return pa.array(rows, _TYPE)


def exact_groups(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, keep_id, group_size, kept, text_sha256)`` for every row of ``df``.

    Texts are equal when identical after A-Z became a-z; null is the empty text, and empty texts are
    equal. The row with the largest key stays, a null key being the smallest; of rows repeated with
    that key one stays. An empty table gives an empty result; other columns are not read.
    """
    rows = staged(df.select(F.col(key).alias("doc_id"), F.arrow_udf(recipes, RECIPE)(F.col(text)).alias("recipe"))
                  .select("doc_id", "recipe.*").withColumn("row", F.monotonically_increasing_id()), "recipes")
    pieces = rows.select("row", F.posexplode("chunks").alias("at", "chunk")).select("row", "at", "chunk.*")
    # A digest that stands for contents of several sizes or checksums is not an identifier; size and checksum then part them.
    identified = staged(
        pieces.groupBy("digest", "size", "crc").agg(F.count("*").alias("n"))
        .withColumn("chunk_id", F.monotonically_increasing_id()), "chunk-ids")
    lists = (pieces.join(identified.drop("n"), ["digest", "size", "crc"])
             .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("at", "chunk_id"))).alias("ids"))
             .select("row", F.col("ids.chunk_id").alias("ids")))
    listed = (rows.select("row", "doc_id", "sha256").join(lists, "row", "left")
              .withColumn("ids", F.coalesce("ids", F.expr("cast(array() as array<bigint>)"))))
    listed = staged(listed, "chunk-lists")
    groups = listed.groupBy("ids", "sha256").agg(
        F.max(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("group_size"))
    return listed.join(groups, ["ids", "sha256"]).select(
        F.col("doc_id").alias(key), F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), F.col("sha256").alias("text_sha256"))
