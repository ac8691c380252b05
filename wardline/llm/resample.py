"""Importance resampling of documents towards a target's n-grams.

A batch's texts are joined with a separator byte that no text holds; one expression pass finds all words
and separators, the separators' places tell by binary search which document a word is of, and runs of
words that reach over a separator are masked before features are counted by bucket. A run's crc32 is
combined from its words' checksums, so no run is ever built as a string.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.functions import broadcast

from wardline.llm.words import cut
from wardline.session import staged

#: Ends a text; not a byte of UTF-8.
SEPARATOR = b"\xff"
_TOKENS = re.compile(rb"[0-9a-z\x80-\xf7]+|\xff")
_GAP = re.compile(rb"[^0-9A-Za-z\x80-\xf7]")
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_END = zlib.crc32(SEPARATOR)
_BLANK = np.uint32(zlib.crc32(b" "))
BLOCK = 1 << 20
WIDEST = 48


def _zero_bytes() -> np.ndarray:
    """``[k, j, b]``: what byte ``j`` of value ``b`` of a checksum becomes behind ``k`` zero bytes."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(0xEDB88320), one >> 1)
    steps = [np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * j) for j in range(4)])]
    for _ in range(WIDEST):
        steps.append((steps[-1] >> np.uint32(8)) ^ one[steps[-1] & np.uint32(255)])
    return np.stack(steps)


_ZEROS = _zero_bytes()


def _shift(crc: np.ndarray, by: np.ndarray | int) -> np.ndarray:
    return (_ZEROS[by, 0, crc & np.uint32(255)] ^ _ZEROS[by, 1, (crc >> np.uint32(8)) & np.uint32(255)]
            ^ _ZEROS[by, 2, (crc >> np.uint32(16)) & np.uint32(255)] ^ _ZEROS[by, 3, crc >> np.uint32(24)])


def combined(first: np.ndarray, second: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc32 of two byte strings one after the other, from both checksums and the second's length."""
    out, left = _shift(first, np.minimum(size, WIDEST)), size - WIDEST
    while len(more := np.flatnonzero(left > 0)):
        out[more] = _shift(out[more], np.minimum(left[more], WIDEST))
        left = left - WIDEST
    return out ^ second


def _blocks(texts: Iterable[bytes]) -> Iterator[bytes]:
    held, size = [], 0
    for text in texts:
        for piece in cut(text, _GAP, BLOCK):
            held.append(piece)
            size += len(piece)
            if size >= BLOCK:
                yield b"".join(held)
                held, size = [], 0
        held.append(SEPARATOR)
    if held:
        yield b"".join(held)


def features(texts: Iterable[bytes], most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(words, text number, crc32)`` arrays of all runs of 1 to ``most`` words, a run length and block at a time."""
    crc, size, past = np.zeros(0, np.uint32), np.zeros(0, np.int64), 0
    for block in _blocks(texts):
        tokens = _TOKENS.findall(block.translate(_FOLD))
        old = len(crc)
        crc = np.concatenate([crc, np.fromiter(map(zlib.crc32, tokens), np.uint32, len(tokens))])
        size = np.concatenate([size, np.fromiter(map(len, tokens), np.int64, len(tokens))])
        end = (size == 1) & (crc == _END)
        ends = np.flatnonzero(end)
        past -= int(np.searchsorted(ends, old))  # separators that were counted with the block before
        run, whole = crc, ~end
        for words in range(1, most + 1):
            if words > 1:
                n = max(len(crc) - words + 1, 0)
                run = combined(_shift(run[:n], 1) ^ _BLANK, crc[words - 1 :], size[words - 1 :])
                whole = whole[:n] & ~end[words - 1 :]
            at = np.flatnonzero(whole)
            at = at[at + words > old]  # others came with the block before
            yield words, past + np.searchsorted(ends, at), run[at]
        past += len(ends)
        crc, size = crc[len(crc) - min(most - 1, len(crc)) :], size[len(size) - min(most - 1, len(size)) :]


def _bytes(column: pa.Array) -> list[bytes]:
    return column.cast(pa.large_binary()).fill_null(b"").to_pylist()


def _bucket_counts(most: int, buckets: int):
    def run(batches):
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, crc in features(_bytes(batch.column(0)), most):
                counts += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["bucket", "n"])
    return run


def bucket_counts(df: DataFrame, text: str = "text", most: int = 2, buckets: int = 10_000) -> np.ndarray:
    """How many features of all texts fall in each bucket; ``buckets`` rows come to the driver."""
    parts = df.select(F.col(text)).mapInArrow(_bucket_counts(most, buckets), "bucket bigint, n bigint")
    counts = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row["bucket"]] = row["n"]
    return counts


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed share in the target and in the corpus, floored."""
    of, to = int(corpus.sum()) + len(corpus), int(target.sum()) + len(target)
    return np.array([math.floor(1000 * math.log((t + 1) * of / ((s + 1) * to))) for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


WEIGHED = "struct<n_words:bigint,n_features:bigint,weight:bigint>"


def _weigh(gains: np.ndarray, most: int):
    def run(column: pa.Array) -> pa.Array:
        n = len(column)
        n_words, n_features, total = (np.zeros(n, np.int64) for _ in range(3))
        for words, doc, crc in features(_bytes(column), most):
            count = np.bincount(doc, minlength=n)
            n_features += count
            if words == 1:
                n_words += count
            total += np.bincount(doc, gains[crc % np.uint32(len(gains))], minlength=n).astype(np.int64)
        return pa.StructArray.from_arrays([n_words, n_features, total // np.maximum(n_features, 1)], ["n_words", "n_features", "weight"])
    return run


def importance(df: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
               most: int = 2, buckets: int = 10_000, least_words: int = 20, share: int = 25, seed: int = 7) -> DataFrame:
    """``(key, n_words, n_features, weight, score, rank)`` for every row of ``df``.

    Features are runs of 1 to ``most`` words (A-Z folded, a word being a run of ASCII letters, digits and
    all other characters), repeats counted. ``weight`` is the floored mean gain of a text's features: how much likelier
    their buckets are in ``target`` than in ``df``, in thousandths of the logarithm. ``score`` adds
    hashed Gumbel noise, so the ``share`` hundredths of the texts with at least ``least_words`` words that score
    highest are a draw without replacement in proportion to e**(weight / 1000); ``rank`` numbers them, ties by smaller
    key, and is null for others. Null and empty texts have no features and weight 0; a null key hashes as no
    digits and is the smallest. Rows that repeat a key are texts of their own with the same noise. With an
    empty target all gains come from the corpus alone. Other columns are not read.
    """
    gains = bucket_gains(bucket_counts(df, text, most, buckets), bucket_counts(target, target_text, most, buckets))
    weighed = df.select(F.col(key).cast("bigint").alias("doc_id"), F.arrow_udf(_weigh(gains, most), WEIGHED)(F.col(text)).alias("w"))
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    noise = F.floor(-1000 * F.log(-F.log(uniform)))
    rows = staged(weighed.select("doc_id", "w.*").withColumn("score", F.col("weight") + noise), "weighed")
    return _ranked(rows, least_words, share).withColumnRenamed("doc_id", key)


def _ranked(rows: DataFrame, least_words: int, share: int) -> DataFrame:
    """Ranks by the counts of equal scores: whole numbers of a range that the logarithms bound (under 100,000),
    whatever the number of rows. The rows of one score are ordered among themselves only."""
    spark, long = rows.sparkSession, F.col("n_words") >= least_words
    counts = sorted(((r["score"], r["n"]) for r in rows.where(long).groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    wanted, above, levels = share * sum(n for _, n in counts) // 100, 0, []
    for score, n in counts:
        if above >= wanted:
            break
        levels.append((score, above))
        above += n
    if not levels:
        return rows.withColumn("rank", F.lit(None).cast("bigint"))
    among = W.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_first(), "n_features")
    drawn = (rows.where(long).join(broadcast(spark.createDataFrame(levels, "score bigint, above bigint")), "score")
             .withColumn("rank", F.col("above") + F.row_number().over(among)).drop("above")
             .withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank"))))
    rest = rows.where(~(long & (F.col("score") >= levels[-1][0]))).withColumn("rank", F.lit(None).cast("bigint"))
    return drawn.select(rest.columns).unionByName(rest)


def resampled(df: DataFrame, target: DataFrame, key: str = "doc_id", **settings) -> DataFrame:
    """The drawn rows of ``df`` with all their columns; settings as in ``importance``. Rows that repeat a key stay
    or go together, rows with a null key go."""
    ranks = importance(df, target, key, **settings)
    return df.join(ranks.where("rank is not null").select(key).distinct(), key, "left_semi").select(df.columns)
