"""The report tables of a whole run, and the figures that its main write leaves behind."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.functions.stats import percent
from wardline.operators import evaluate, explain, explore, profile, split
from wardline.plans.prepare import CleaningParams
from wardline.sources import files
from wardline.sources.layout import KEY


def observed_gaps(spark: SparkSession, metrics: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """(column, missing_before, pct_before, missing_after, pct_after) from the metrics of ``prepare``."""
    before, after = metrics["before"], metrics["after"]
    columns = [k.removeprefix("known_") for k in before if k.startswith("known_")]
    rows = [(c, before["rows"], before["rows"] - before[f"known_{c}"], after["rows"], after["rows"] - after[f"known_{c}"]) for c in columns]
    table = spark.createDataFrame(rows, "column string, _b bigint, missing_before bigint, _a bigint, missing_after bigint")
    def share(count, of):
        return F.coalesce(percent(F.col(count), F.col(of), 2), F.lit(0.0))
    return table.select("column", "missing_before", share("missing_before", "_b").alias("pct_before"),
                        "missing_after", share("missing_after", "_a").alias("pct_after"))


def observed_quality(spark: SparkSession, metrics: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """Rows removed, gaps before and after, and the share of filled cells in percent, like ``profile.quality_score``."""
    gaps = observed_gaps(spark, metrics).agg(F.sum("missing_before").alias("nulls_before"), F.sum("missing_after").alias("nulls_after"),
                                             F.count("*").alias("_columns"))
    before, after = (F.lit(metrics[k]["rows"]).cast("bigint") for k in ("before", "after"))
    cells = F.greatest(after * F.col("_columns"), F.lit(1))
    return gaps.select(before.alias("rows_before"), after.alias("rows_after"), (before - after).alias("rows_removed"),
                       "nulls_before", "nulls_after", F.round((1 - F.col("nulls_after") / cells) * 100, 2).alias("quality_score"))


def observed_imputation(spark: SparkSession, metrics: Mapping[str, Mapping[str, int]], params: CleaningParams) -> DataFrame:
    """(column, strategy, value, n_filled) of every imputed column."""
    fits = [(c, "median", str(float(v))) for c, v in params.medians.items()] + [(c, "mode", str(v)) for c, v in params.modes.items()]
    seen = metrics["before"]
    rows = [(c, s, v, seen["rows"] - seen[f"known_{c}"]) for c, s, v in fits]
    return spark.createDataFrame(rows, "column string, strategy string, value string, n_filled bigint")


def run_reports(
    raw: DataFrame, rows: DataFrame, coded: DataFrame, made: Sequence[str], scaled: DataFrame, numeric: Sequence[str],
    numbers: Sequence[str], predictions: DataFrame, model, features: Sequence[str], target: str,
) -> dict[str, DataFrame]:
    """The seven tables of a run by name: ``raw`` rows with gaps, prepared ``rows``, featured ``coded`` rows with ``target_code``
    and the columns ``made``, ``scaled`` splits and their ``numbers``, predictions, and a fitted ensemble."""
    checked = profile.feature_validation(coded, made, "target_code")
    return {
        "initial_quality": profile.describe(raw, raw.columns),
        "class_statistics": explore.class_stats(rows, numeric, target),
        "feature_validation": checked,
        "split_summary": split.split_summary(scaled, "label"),
        "split_statistics": explore.part_stats(scaled.drop(KEY, "label"), numbers, "split"),
        "model_comparison": evaluate.compare_models(predictions),
        "feature_importance": explain.impurity_importance(scaled, model, features),
    }


def write_run(tables: Mapping[str, DataFrame], path: str) -> dict[str, T.StructType]:
    """Write every table as CSV under its name; the schemas to read them with."""
    files.write_reports(tables, path)
    return {name: df.schema for name, df in tables.items()}


def read_report(spark: SparkSession, path: str, name: str, schemas: Mapping[str, T.StructType]) -> DataFrame:
    return files.read_typed_csv(spark, f"{path}/{name}", schemas[name])
