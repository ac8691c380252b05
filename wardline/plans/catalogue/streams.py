"""Bounded runs of the streaming jobs, and what each leaves behind."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.plans.catalogue.cleaning import rounded
from wardline.plans.catalogue.scoring import scored_records, scoring_inputs
from wardline.session import work_path
from wardline.streaming import alerts, jobs


def _arrivals(spark, df, name):
    """A table as files that arrive one after another."""
    path = work_path(spark, name)
    df.repartition(4).write.parquet(path)
    return path


def str01_scored_stream(spark, folder):
    """Arriving encounters scored and appended; the batch query gives the same rows."""
    inputs = scoring_inputs(spark, folder)
    source = _arrivals(spark, inputs, "arrivals")
    out, state = work_path(spark, "scored-stream"), work_path(spark, "state")
    stream = jobs.read_stream(spark, source, inputs.schema, files_per_batch=2)
    jobs.finish(jobs.append_to_files(jobs.score_stream(stream), out, state))
    return spark.read.parquet(out).withColumn(
        "timestamp", F.date_format("timestamp", "yyyy-MM-dd"))


def str02_without_resent(spark, folder):
    """Every record sent twice; one of each is kept."""
    records = scored_records(spark, folder).select("record_id", "timestamp", "status")
    source = _arrivals(spark, records.unionByName(records), "resent")
    out, state = work_path(spark, "deduplicated"), work_path(spark, "state")
    stream = jobs.with_event_time(
        jobs.read_stream(spark, source, records.schema, files_per_batch=2),
        "timestamp", "5000 days")
    jobs.finish(jobs.append_to_files(jobs.without_resent(stream), out, state))
    return spark.read.parquet(out).select("record_id", "status")


def _in_slices(spark, records, slices, name, run):
    """Run a stream once for each slice of the records, which arrive in order of time, in any number of files; a run goes on
    from the state that the one before left. ``run(path, schema, out, state)`` starts the stream."""
    source, out, state = work_path(spark, name), work_path(spark, f"{name}-out"), work_path(spark, f"{name}-state")
    parts = jobs.state_partitions(spark, records.count())
    for some in slices:
        some.write.mode("append").parquet(source)
        with jobs.shuffle_partitions(spark, parts):
            jobs.finish(run(source, records.schema, out, state))
    return spark.read.parquet(out)


def _by_time(records, time="timestamp"):
    """Quarters of the records by time."""
    marks = records.agg(F.percentile_approx(time, [0.25, 0.5, 0.75])).first()[0]
    bounds = [None, *marks, None]
    return [records.where((F.lit(low is None) | (F.col(time) > low)) & (F.lit(high is None) | (F.col(time) <= high)))
            for low, high in zip(bounds, bounds[1:])]


def str02_resent_within_days(spark, folder):
    """Records in order of time, each sent twice; state reaches back three days only, so rows of
    the first day that come with the last files are too late and dropped."""
    records = scored_records(spark, folder).select("record_id", "timestamp", "status")
    first = records.agg(F.min("timestamp")).first()[0]
    slices = [some.unionByName(some) for some in _by_time(records)]
    slices[-1] = slices[-1].unionByName(records.where(F.to_date("timestamp") == F.to_date(F.lit(first))).withColumn(
        "record_id", -F.col("record_id") - 1))

    def run(source, schema, out, state):
        stream = jobs.with_event_time(jobs.read_stream(spark, source, schema), "timestamp", "3 days")
        return jobs.append_to_files(jobs.without_resent(stream), out, state)

    return _in_slices(spark, records, slices, "resent-in-order", run).select("record_id", "status")


def scr12_follow_up_alerts(spark, folder):
    """Records that start a follow-up alert, one per patient in thirty days, from records that arrive in order of time but
    for three days. The last one, of no patient, is far ahead and closes the stream."""
    alerts.use_rocksdb(spark)
    records = scored_records(spark, folder).select(
        "patient_name", "record_id", F.col("timestamp").cast("timestamp"), (F.col("risk_score") / 100).alias("probability"))
    last = records.agg(F.max("timestamp")).first()[0]
    end = spark.createDataFrame([(None, -1, last, None)], alerts.ALERT).withColumn("timestamp", F.col("timestamp") + F.expr("interval 100 days"))

    def run(source, schema, out, state):
        stream = jobs.with_event_time(jobs.read_stream(spark, source, schema), "timestamp", "3 days")
        return jobs.append_to_files(alerts.follow_up_alerts(stream), out, state)

    found = _in_slices(spark, records, [*_by_time(records), end], "alerts", run)
    return found.select("patient_name", "record_id", F.date_format("timestamp", "yyyy-MM-dd").alias("timestamp"))


def str03_status_windows(spark, folder):
    """Daily count and mean value per event type, revised as files arrive."""
    events = spark.read.parquet(f"{folder}/events.parquet").select(
        F.col("ts").alias("timestamp"), F.col("event_type").alias("status"),
        F.col("value").alias("risk_score"))
    source = _arrivals(spark, events, "events")
    out, state = work_path(spark, "windows"), work_path(spark, "state")
    stream = jobs.with_event_time(
        jobs.read_stream(spark, source, events.schema, files_per_batch=1),
        "timestamp", "60 days")
    jobs.finish(jobs.revisions_to_files(jobs.status_windows(stream), out, state))
    latest = jobs.newest_revisions(spark.read.parquet(out), "start", "status")
    return rounded(latest.withColumn("start", F.date_format("start", "yyyy-MM-dd")))


QUERIES = {f.__name__: f for f in (
    str01_scored_stream, str02_without_resent, str02_resent_within_days, str03_status_windows,
    scr12_follow_up_alerts)}
