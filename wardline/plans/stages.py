"""Stages the catalogue shares: each is built once per session and folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.operators.features import engineer
from wardline.plans.prepare import CleaningParams, binary_target, prepare
from wardline.session import ROWS_A_TASK, small_methods, staged
from wardline.sources.encounters import encounters

_built: dict[tuple, object] = {}


def once(spark: SparkSession, folder: str, name: str, build):
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _built:
        _built[key] = build()
    return _built[key]


def raw(spark: SparkSession, folder: str) -> DataFrame:
    """The raw encounter table as files, the way a user has it."""
    def build():
        with small_methods(spark):
            return staged(encounters(spark, folder), "raw", rows_a_file=ROWS_A_TASK)

    return once(spark, folder, "raw", build)


def cleaned(spark: SparkSession, folder: str) -> tuple[DataFrame, CleaningParams]:
    """Imputed, typed, distinct, winsorised encounters and what was learned."""
    return once(spark, folder, "cleaned", lambda: prepare(raw(spark, folder)))


def prepared(spark: SparkSession, folder: str) -> DataFrame:
    return cleaned(spark, folder)[0]


def engineered(spark: SparkSession, folder: str) -> DataFrame:
    """The feature columns as a plain projection over the prepared rows."""
    return engineer(prepared(spark, folder))


def featured(spark: SparkSession, folder: str) -> DataFrame:
    """The featured table as files, for the stages that read it several times."""
    def build():
        rows = engineered(spark, folder)
        with small_methods(spark):
            return staged(rows, "featured")

    return once(spark, folder, "featured", build)


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    return binary_target(featured(spark, folder))


def class_code(df: DataFrame) -> DataFrame:
    """The three-valued target in alphabetical order."""
    return df.withColumn(
        "target_code",
        F.when(F.col("readmitted") == "<30", 0).when(F.col("readmitted") == ">30", 1)
        .when(F.col("readmitted") == "NO", 2),
    )
