"""The record store: upserts, dates, and reads of the last partitions."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from wardline.sources import store

SCHEMA = "record_id bigint, timestamp timestamp, status string, risk double"


def at(day, hour=0):
    return datetime.datetime(2025, 1, 1) + datetime.timedelta(days=day, hours=hour)


def rows_of(df):
    return sorted((r.record_id is None, r.record_id or 0, str(r.timestamp), r.status, r.risk) for r in df.collect())


def files_of(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_upserts_equal_a_dictionary(spark, tmp_path):
    rng, held, path = random.Random(6), {}, str(tmp_path / "store")
    for _ in range(4):
        batch = {}
        for _ in range(120):
            key = rng.choice([None, *range(150)])
            row = (key, rng.choice([None, at(rng.randrange(12), rng.randrange(24))]), rng.choice(["LOW", "HIGH"]), rng.random())
            batch[key] = max([batch[key], row], key=lambda r: (r[1] is not None, r[1] or 0, r[3], r[2])) if key in batch else row
        sent = spark.createDataFrame(list(batch.values()), SCHEMA)
        store.upsert(sent, path)
        held |= batch
        want = rows_of(spark.createDataFrame(list(held.values()), SCHEMA))
        got = store.read_store(spark, path)
        assert rows_of(got) == want
        assert got.where(F.col("period") != F.coalesce(F.date_format("timestamp", "yyyyMMdd").cast("int"), F.lit(0))).isEmpty()
        store.upsert(sent, path)  # again
        assert rows_of(store.read_store(spark, path)) == want
    assert store.periods(spark, path) == sorted({int(r[1].strftime("%Y%m%d")) if r[1] else 0 for r in held.values()})


def test_only_touched_days_are_written(spark, tmp_path):
    path = tmp_path / "store"
    store.upsert(spark.createDataFrame([(k, at(k % 10), "LOW", 0.0) for k in range(100)], SCHEMA), str(path))
    before = files_of(path)
    store.upsert(spark.createDataFrame([(3, at(3), "HIGH", 1.0), (500, at(20), "LOW", 0.0)], SCHEMA), str(path))
    after = files_of(path)
    changed = {f.split("/")[0] for f in set(before) ^ set(after)}
    assert changed == {"period=20250104", "period=20250121"}


def test_a_record_that_moves_leaves_its_old_day(spark, tmp_path):
    path = str(tmp_path / "store")
    store.upsert(spark.createDataFrame([(1, at(0), "LOW", 0.0), (2, at(1), "LOW", 0.0)], SCHEMA), path)
    store.upsert(spark.createDataFrame([(1, at(5), "HIGH", 1.0)], SCHEMA), path)
    assert store.periods(spark, path) == [20250102, 20250106]
    assert [r[0] for r in rows_of(store.read_store(spark, path))] == [False, False]


def test_repeated_keys_in_a_batch_and_empty_batches(spark, tmp_path):
    path = str(tmp_path / "store")
    store.upsert(spark.createDataFrame([(1, at(0), "LOW", 0.0), (1, at(2), "HIGH", 0.0), (1, at(2), "LOW", 0.5)], SCHEMA), path)
    assert rows_of(store.read_store(spark, path))[0][3:] == ("LOW", 0.5)
    before = files_of(tmp_path / "store")
    store.upsert(spark.createDataFrame([], SCHEMA), path)
    assert files_of(tmp_path / "store") == before
    with pytest.raises(ValueError):
        store.newest(spark, str(tmp_path / "nothing"), 5)


@pytest.mark.parametrize("n", [1, 7, 25, 1000])
def test_newest_first_opens_the_last_partitions_only(spark, tmp_path, n):
    path = str(tmp_path / "store")
    rows = [(k, at(k % 40, k % 7) if k % 50 else None, "LOW", 0.0) for k in range(300)]
    store.upsert(spark.createDataFrame(rows, SCHEMA), path, moving=False)
    found = store.newest(spark, path, n)
    order = sorted(rows, key=lambda r: (r[1] is None, -r[1].timestamp() if r[1] else 0, r[0]))
    assert [r.record_id for r in found.collect()] == [r[0] for r in order[:n]]
    opened = {f.split("period=")[1].split("/")[0] for f in found.inputFiles()}
    plan = found._jdf.queryExecution().executedPlan().toString()
    if n < 25:
        assert "PartitionFilters: [isnotnull(period" in plan
        read = store.read_store(spark, path, 20250208)
        assert "PartitionFilters" in read._jdf.queryExecution().executedPlan().toString() and read.count() < 300
    assert len(opened) >= 1
