"""The report tables of one run, the figures its write leaves behind, and profiles of appended data."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.operators import profile, summaries
from wardline.plans import reports, stages
from wardline.plans.catalogue.cleaning import known, rounded
from wardline.plans.catalogue.modelling import fitted
from wardline.plans.catalogue.scoring import predictions
from wardline.plans.model_table import SCALED, scaled_split
from wardline.plans.prepare import prepare
from wardline.operators.features import ENGINEERED
from wardline.session import staged, work_path
from wardline.sources.layout import NUMERIC, TARGET


def _observed(spark, folder):
    """Metrics that the write of the prepared rows collected, and what the preparation learned."""
    def build():
        metrics = {}
        return metrics, prepare(stages.raw(spark, folder), metrics=metrics)[1]

    return stages.once(spark, folder, "observed", build)


def prf02_observed_gaps(spark, folder):
    return reports.observed_gaps(spark, _observed(spark, folder)[0])


def prf08_observed_quality(spark, folder):
    return reports.observed_quality(spark, _observed(spark, folder)[0])


def cln03_observed_imputation(spark, folder):
    return reports.observed_imputation(spark, *_observed(spark, folder))


def _run(spark, folder):
    """All seven tables, written by one run."""
    def build():
        models, features = fitted(spark, folder)
        tables = reports.run_reports(
            known(spark, folder), stages.prepared(spark, folder), stages.class_code(stages.featured(spark, folder)), ENGINEERED,
            scaled_split(spark, folder)[0], NUMERIC, SCALED, predictions(spark, folder), models["Random Forest"], features, TARGET)
        path = work_path(spark, "run-reports")
        return path, reports.write_run(tables, path)

    return stages.once(spark, folder, "run-reports", build)


def _read(spark, folder, name):
    path, schemas = _run(spark, folder)
    return reports.read_report(spark, path, name, schemas)


def snk06_initial_quality(spark, folder):
    return rounded(_read(spark, folder, "initial_quality"))


def snk06_class_statistics(spark, folder):
    return rounded(_read(spark, folder, "class_statistics"), 3)


def snk06_feature_validation(spark, folder):
    return rounded(_read(spark, folder, "feature_validation").drop("dtype", "feature_type"))


def snk06_feature_kinds(spark, folder):
    return _read(spark, folder, "feature_validation").select("feature", "feature_type")


def snk06_split_summary(spark, folder):
    return _read(spark, folder, "split_summary")


def snk06_split_statistics(spark, folder):
    return rounded(_read(spark, folder, "split_statistics"), 4)


def snk06_model_comparison(spark, folder):
    return _read(spark, folder, "model_comparison")


def snk06_feature_importance(spark, folder):
    return rounded(_read(spark, folder, "feature_importance"))


def _summaries(spark, folder):
    """Summaries of four batches of the encounters, one of them stored twice."""
    def build():
        path, rows = work_path(spark, "summaries"), known(spark, folder)
        for k in (0, 1, 2, 3, 2):
            summaries.store_summary(summaries.summarise(rows.where(F.col("encounter_id") % 4 == k)), path, f"b{k}")
        return staged(summaries.merge(summaries.stored_summaries(spark, path)), "merged")

    return stages.once(spark, folder, "summaries", build)


def prf04_incremental_profile(spark, folder):
    """A profile of all batches from their summaries."""
    made = summaries.profile(_summaries(spark, folder))
    return rounded(made.select("column", "n", "missing_count", "missing_pct", "mean", "std", "min", "max"))


def prf10_incremental_distinct(spark, folder):
    """Whether the merged sketches are within five hundredths of the exact distinct counts."""
    rows = known(spark, folder)
    exact = profile.distinct_counts(rows, rows.columns).withColumnRenamed("n_distinct", "exact")
    return summaries.profile(_summaries(spark, folder)).join(exact, "column").select(
        "column", "exact", (F.abs(F.col("n_distinct") - F.col("exact")) <= F.greatest(0.05 * F.col("exact"), F.lit(0.5))).alias("close"))


def agg09_incremental_histogram(spark, folder):
    """Ten bins of every number, which add up to the known values."""
    bins = summaries.histogram(_summaries(spark, folder), 10).where(F.col("column").isin(NUMERIC))
    return bins.groupBy("column").agg(
        F.count("*").alias("bins"), F.sum("n").alias("n"), F.min("bin_start").alias("low"), F.max("bin_end").alias("high"))


QUERIES = {f.__name__: f for f in (
    prf02_observed_gaps, prf08_observed_quality, cln03_observed_imputation, snk06_initial_quality, snk06_class_statistics,
    snk06_feature_validation, snk06_feature_kinds, snk06_split_summary, snk06_split_statistics, snk06_model_comparison,
    snk06_feature_importance, prf04_incremental_profile, prf10_incremental_distinct, agg09_incremental_histogram,
)}
