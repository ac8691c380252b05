"""Reading the text tables, and small helpers the operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import broadcast

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = r"[\x20\x09-\x0D]+"

#: Rows a side may have to be sent to every executor; its rows are a few numbers each.
BROADCAST_ROWS = 1_000_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_ascii(column):
    """A-Z to a-z, every other character as it is."""
    return F.translate(column, UPPER, LOWER)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The side with a broadcast hint if it was counted and has at most ``rows`` rows."""
    return broadcast(df) if df.limit(rows + 1).count() <= rows else df


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, sample: int) -> DataFrame:
    """``(key, text, label, spread)`` of at most ``sample`` keys of ``labels`` with a 0/1 label.

    The keys of the smallest hashes are taken, so the sample is the same on any partitioning, and it is
    small enough to send to the documents. Of labels or texts repeated for a key the largest is read.
    """
    picked = (labels.where(F.col(label).isin(0, 1)).where(F.col(key).isNotNull())
              .groupBy(F.col(key).alias("key")).agg(F.max(F.col(label)).cast("int").alias("label"))
              .withColumn("spread", F.xxhash64("key")).orderBy("spread", "key").limit(sample))
    return (docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
            .join(broadcast(picked), "key").groupBy("key", "label", "spread").agg(F.max("text").alias("text")))


def remainder(key, by: int):
    """crc32 of the key as text, modulo ``by``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % by
