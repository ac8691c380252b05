"""Follow-up alerts of a stream against a plain loop over the records in order of time."""

import datetime
import random

import pytest

from wardline.streaming import alerts, jobs

START = datetime.datetime(2025, 1, 1)
END = (None, -1, datetime.datetime(2035, 1, 1), None)


def plain(rows, bound=0.5, days=30):
    out, last = [], {}
    for name, record, time, p in sorted((r for r in rows if r[0] is not None and r[1] is not None and r[2] is not None and r[3] is not None), key=lambda r: (r[2], r[1])):
        if p > bound and (name not in last or time >= last[name] + datetime.timedelta(days=days)):
            last[name] = time
            out.append((name, record))
    return sorted(out)


def run(spark, tmp_path, batches, lateness):
    """Each batch of rows is one file and one trigger."""
    alerts.use_rocksdb(spark)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    sizes = []
    for batch in batches:
        spark.createDataFrame(batch, alerts.ALERT).coalesce(1).write.mode("append").parquet(source)
        stream = jobs.with_event_time(jobs.read_stream(spark, source, spark.read.parquet(source).schema, 1), "timestamp", lateness)
        query = jobs.append_to_files(alerts.follow_up_alerts(stream), out, str(tmp_path / "state"))
        jobs.finish(query)
        sizes.append(query.recentProgress[-1].stateOperators[0].numRowsTotal if query.recentProgress else None)
    return sorted((r.patient_name, r.record_id) for r in spark.read.parquet(out).collect()), sizes


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    out = [(f"p{rng.randrange(9)}", k, START + datetime.timedelta(hours=rng.randrange(24 * 200)), rng.random()) for k in range(400)]
    return out + [("p1", 900, START + datetime.timedelta(days=30), 0.9), ("p1", 901, START, 0.9), ("p1", 902, START, 0.95), (None, 903, START, 0.9),
                  ("p2", 904, None, 0.9), ("p2", 905, START, None), ("p3", None, START, 0.9)]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_arrival_within_the_lateness(spark, tmp_path, rows, seed):
    shuffled = rows[:]
    random.Random(seed).shuffle(shuffled)
    found, _ = run(spark, tmp_path, [shuffled[:150], shuffled[150:], [END]], "300 days")
    assert found == plain(rows)


def test_state_stays_bounded_and_ends_empty(spark, tmp_path):
    """A hundred days of records of ever new patients: state holds the last days, not all patients."""
    rows = [(f"p{day}-{i}", day * 10 + i, START + datetime.timedelta(days=day), 0.9) for day in range(0, 100) for i in range(10)]
    batches = [[r for r in rows if a <= r[1] < a + 200] for a in range(0, 1000, 200)]
    found, sizes = run(spark, tmp_path, [*batches, [END]], "2 days")
    assert found == plain(rows) and len(found) == 1000
    # Open alerts of thirty days and a few that wait: a value and a timer each.
    assert max(sizes[:-1]) < 10 * 36 * 2 and sizes[-1] == 0


def test_state_goes_by_groups_of_patients(spark, tmp_path):
    """Many patients and records share a value and a timer, instead of some for each, and do not mix."""
    rows = [(f"p{k % 3000}", k, START + datetime.timedelta(minutes=k), 0.9) for k in range(6000)]
    found, sizes = run(spark, tmp_path, [rows, [END]], "300 days")
    assert found == plain(rows) and len(found) == 3000 and sizes[0] <= alerts.GROUPS and sizes[-1] == 0


def test_state_parts_go_by_rows_and_cores(spark):
    cores, before = spark.sparkContext.defaultParallelism, spark.conf.get("spark.sql.shuffle.partitions")
    assert jobs.state_partitions(spark, 0) == jobs.state_partitions(spark, 1000) == cores
    assert jobs.state_partitions(spark, 54_000_000) == 216
    with jobs.shuffle_partitions(spark, 3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_records_behind_the_watermark_are_dropped(spark, tmp_path):
    first, late = ("a", 1, START + datetime.timedelta(days=50), 0.9), ("b", 2, START, 0.9)
    found, _ = run(spark, tmp_path, [[first], [("c", 3, START + datetime.timedelta(days=60), 0.1)], [late], [END]], "2 days")
    assert found == [("a", 1)]
