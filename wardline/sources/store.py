"""The record store: date partitions, upserts by key, and newest-first reads of the last partitions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.session import staged

PERIOD = "period"
#: Patterns of a partition: its number ends with the last unit of time.
BY_DAY, BY_MONTH = "yyyyMMdd", "yyyyMM"


def period_of(time: str, pattern: str = BY_DAY):
    """The partition of a time, as a number like 20251202; 0, which sorts before all, for none."""
    return F.coalesce(F.date_format(time, pattern).cast("int"), F.lit(0)).alias(PERIOD)


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def periods(spark: SparkSession, path: str) -> list[int]:
    """Partitions that the store has, oldest first: a listing of folders, no file is opened."""
    files, place = _place(spark, path)
    if not files.exists(place):
        return []
    names = [s.getPath().getName() for s in files.listStatus(place) if s.isDirectory()]
    return sorted(int(n.removeprefix(f"{PERIOD}=")) for n in names if n.startswith(f"{PERIOD}="))


def read_store(spark: SparkSession, path: str, first: int | None = None) -> DataFrame:
    """All records, or those from a partition on; older ones are not opened."""
    rows = spark.read.parquet(path)
    return rows if first is None else rows.where(F.col(PERIOD) >= first)


def newest_version(records: DataFrame, key: str, time: str) -> DataFrame:
    """One record of each key: the newest, and of equal times the largest."""
    fields = [c for c in records.columns if c != key]
    order = F.struct(F.col(time), F.struct(*[F.col(c) for c in sorted(fields)]))
    return records.groupBy(key).agg(F.max_by(F.struct(*fields), order).alias("_r")).select(key, "_r.*").select(records.columns)


def upsert(records: DataFrame, path: str, key: str = "record_id", time: str = "timestamp",
           pattern: str = BY_DAY, moving: bool = True) -> None:
    """Put records into the store at ``path``; one whose key is there replaces it, so a batch that is put twice, or put
    again after a failure, leaves the store as after the first time.

    Only the partitions that the batch touches are written again, by dynamic partition overwrite. A record that
    replaces one of another date removes it there; to find it the keys of the whole store are read, two narrow
    columns, unless ``moving`` is false because a key's time never changes. Of records that
    repeat a key in the batch the newest stays; a null key is a key like any other. A null time is
    stored in partition 0. A store keeps the ``pattern`` it began with.
    An empty batch changes nothing.
    """
    spark = records.sparkSession
    batch = staged(newest_version(records, key, time).withColumn(PERIOD, period_of(time, pattern)), "batch")
    touched = {r[PERIOD] for r in batch.select(PERIOD).distinct().collect()}  # dates, not rows
    if not touched:
        return
    held = periods(spark, path)
    if held:
        keys = batch.select(F.col(key).alias("_key"))
        store = spark.read.parquet(path)
        if moving:
            same = store.select(key, PERIOD).join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_semi")
            touched |= {r[PERIOD] for r in same.select(PERIOD).distinct().collect()}
        old = store.where(F.col(PERIOD).isin(sorted(touched))).join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_anti")
        batch = staged(old.unionByName(batch, allowMissingColumns=True), "touched")
    # Partitions are evened out: a large one is written by several tasks, small ones share a task.
    (batch.hint("rebalance", PERIOD).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(PERIOD).parquet(path))
    left = {r[PERIOD] for r in batch.select(PERIOD).distinct().collect()}
    files, _ = _place(spark, path)
    for gone in touched & set(held) - left:  # its last records moved elsewhere
        files.delete(_place(spark, f"{path}/{PERIOD}={gone}")[1], True)


def newest(spark: SparkSession, path: str, n: int, key: str = "record_id", time: str = "timestamp") -> DataFrame:
    """The ``n`` newest records, equal times in key order.

    Partitions are counted from the last one back, twice as many each time, until they hold ``n``; only their files are read.
    """
    held = periods(spark, path)[::-1]
    if not held:
        raise ValueError(f"nothing is stored at {path}")
    some = 1
    while some < len(held) and read_store(spark, path, held[some - 1]).count() < n:
        some *= 2
    first = held[min(some, len(held)) - 1]
    return read_store(spark, path, first).drop(PERIOD).orderBy(F.desc(time), key).limit(n)
