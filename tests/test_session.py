"""Settings of the jobs that read wide rows."""

import pytest
from pyspark.sql import functions as F

from wardline.plans.prepare import prepare
from wardline.session import read_in_parts, setting, small_methods, staged


def test_settings_come_back(spark):
    own, none = "spark.sql.codegen.hugeMethodLimit", "spark.sql.files.minPartitionNum"
    before = spark.conf.get(own)
    with small_methods(spark), read_in_parts(spark, 1000):
        assert (spark.conf.get(own), spark.conf.get(none)) == ("8000", "1000")
    with pytest.raises(ValueError), setting(spark, none, 3):
        raise ValueError
    assert (spark.conf.get(own), spark.conf.get(none, None)) == (before, None)


def test_a_task_reads_a_bounded_number_of_rows(spark, monkeypatch):
    """Equal values make small files, which are no longer packed together by size when whole rows are grouped."""
    rows = spark.range(0, 20_000, 1, 2).select("id", F.lit("a").alias("b"))
    files = staged(rows, "narrow", rows_a_file=500)
    with read_in_parts(spark, 40):
        sizes = [len(x) for x in files.rdd.glom().collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= 500

    seen = []
    monkeypatch.setattr("wardline.plans.prepare.ROWS_A_TASK", 500)
    monkeypatch.setattr("wardline.plans.prepare.staged", lambda df, name: seen.append(df.sparkSession.conf.get(
        "spark.sql.files.minPartitionNum", None)) or staged(df, name))
    for metrics in (None, {}):
        assert prepare(files, metrics=metrics)[0].count() == 20_000
    assert seen == ["40", "40"]
