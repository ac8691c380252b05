"""Feature importance: impurity, permutation and partial dependence."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardline.functions.codes import order_hash
from wardline.operators.profile import sample_rows
from wardline.operators.quantiles import column_quantiles
from wardline.operators.trees import Trees, mean_by_interval, tree_table
from wardline.session import cut_lineage

# Sizes of the importance jobs.
PERMUTATION_ROWS, PERMUTATION_REPEATS = 1000, 5
GRID_POINTS, GRID_LOW, GRID_HIGH = 50, 0.05, 0.95
TOP_IMPORTANCES, TOP_DEPENDENCE = 15, 4


def impurity_importance(rows: DataFrame, model, features: Sequence[str]) -> DataFrame:
    """(feature, importance) of a tree model, largest first."""
    values = model.featureImportances.toArray()
    table = rows.sparkSession.createDataFrame(
        [(f, float(v)) for f, v in zip(features, values)], "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


def strongest_importances(table: DataFrame, value: str, k: int = TOP_IMPORTANCES) -> DataFrame:
    """The top ``k`` with their place between the smallest and largest of them."""
    top = table.orderBy(F.desc(value), "feature").limit(k)
    span = top.agg(F.min(value).alias("_lo"), F.max(value).alias("_hi")).first()
    return top.withColumn(
        "normalised", (F.col(value) - span["_lo"]) / (span["_hi"] - span["_lo"] + 1e-9))


def permutation_importance(
    model, rows: DataFrame, features: Sequence[str], key: str, label: str = "label",
    sample: int = PERMUTATION_ROWS, repeats: int = PERMUTATION_REPEATS, seed: int = 42,
) -> DataFrame:
    """(feature, importance_mean, importance_std): drop in accuracy when one column is shuffled.

    The seeded sample is the operator's own definition. Each sampled row is copied
    once per feature and repeat, takes the feature value of the row in its place of
    that repeat's permutation, and all copies are scored in a single pass.
    """
    picked = cut_lineage(sample_rows(rows.select(key, *features, label), key, sample, seed))
    vectors = picked.select(
        key, label, F.array(*[F.col(c).cast("double") for c in features]).alias("x"))
    numbered = F.explode(F.sequence(F.lit(1), F.lit(repeats))).alias("repeat")
    # One window per repeat over the bounded sample; both sides number the same rows.
    by_key = W.partitionBy("repeat").orderBy(key)
    by_hash = W.partitionBy("repeat").orderBy(order_hash(F.col(key), F.col("repeat"), seed=seed))
    target = vectors.select("*", numbered).withColumn("_place", F.row_number().over(by_key))
    source = vectors.select(key, F.col("x").alias("other"), numbered).withColumn(
        "_place", F.row_number().over(by_hash)).drop(key)
    paired = target.join(source, ["repeat", "_place"])
    # A few thousand rows become many once copied; spread them before that.
    cores = rows.sparkSession.sparkContext.defaultParallelism
    copies = paired.repartition(2 * cores).select(
        "repeat", label, "x", "other",
        F.explode(F.sequence(F.lit(0), F.lit(len(features) - 1))).alias("_f"))
    swapped = copies.select(
        "repeat", label, "_f",
        F.transform("x", lambda v, i: F.when(
            i == F.col("_f"), F.element_at("other", (F.col("_f") + 1).cast("int"))
        ).otherwise(v)).alias("x"))
    base = _accuracy(model, vectors.withColumn("_g", F.lit(0)), ["_g"], label).first()["accuracy"]
    scores = _accuracy(model, swapped, ["_f", "repeat"], label)
    names = F.array(*map(F.lit, features))
    return (
        scores.groupBy("_f").agg(
            F.avg(F.lit(base) - F.col("accuracy")).alias("importance_mean"),
            F.stddev_pop("accuracy").alias("importance_std"))
        .select(F.element_at(names, F.col("_f") + 1).alias("feature"),
                "importance_mean", "importance_std")
        .orderBy(F.desc("importance_mean"), "feature")
    )


def _accuracy(model, rows: DataFrame, by: Sequence[str], label: str) -> DataFrame:
    scored = model.transform(rows.withColumn("features", array_to_vector("x")))
    hit = (F.col("prediction") == F.col(label)).cast("int")
    return scored.groupBy(*by).agg(F.avg(hit).alias("accuracy"))


def dependence_grid(
    rows: DataFrame, columns: Sequence[str], points: int = GRID_POINTS
) -> dict[str, list[float]]:
    """Even grid between the 5th and 95th percentile, or the distinct values if fewer."""
    few = {
        c: [r[0] for r in rows.where(F.col(c).isNotNull()).select(c).distinct()
            .limit(points + 1).collect()]
        for c in columns
    }
    wide = [c for c in columns if len(few[c]) > points]
    ends = column_quantiles(rows, wide, [GRID_LOW, GRID_HIGH])
    out = {}
    for c in columns:
        if c in ends:
            low, high = ends[c]
            out[c] = [low + (high - low) * i / (points - 1) for i in range(points)]
        else:
            out[c] = sorted(float(v) for v in few[c])
    return out


def partial_dependence(
    model, rows: DataFrame, features: Sequence[str], columns: Sequence[str],
    points: int = GRID_POINTS,
) -> DataFrame:
    """(feature, grid_value, average): mean probability with one column set to each value.

    For an ensemble of trees, as a fitted model or a table, every row goes through each tree once with the column
    left open, and the averages at all values follow from sums over the intervals between its
    thresholds. Other models score a copy of each row for every value. No rows give no averages.
    """
    grid = dependence_grid(rows, columns, points)
    try:
        trees = model if isinstance(model, Trees) else tree_table(model)
    except ValueError:
        return dependence_by_copies(model, rows, features, grid)
    places = {c: i for i, c in enumerate(features)}
    inputs = rows.select(F.array(*[F.col(c).cast("double") for c in features]).alias("x"))
    means = mean_by_interval(inputs, trees, [places[c] for c in columns], "x")
    found = [(c, v, float(average))
             for c in columns if means
             for cuts, averages in [means[places[c]]]
             for v, average in zip(grid[c], averages[np.searchsorted(cuts, grid[c])])]
    return rows.sparkSession.createDataFrame(found, "feature string, grid_value double, average double")


def dependence_by_copies(model, rows: DataFrame, features: Sequence[str], grid: Mapping[str, Sequence[float]]) -> DataFrame:
    """The same for any model and ``grid``: every row meets a fixed number of values, in place, and the means are
    combined before the shuffle."""
    places = {c: i for i, c in enumerate(features)}
    spots = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.lit(places[c]).alias("at"),
                 F.lit(float(v)).alias("grid_value"))
        for c in grid for v in grid[c]])
    copied = rows.select(
        F.array(*[F.col(c).cast("double") for c in features]).alias("x"),
        F.explode(spots).alias("_s")).select(
        "_s.feature", "_s.grid_value",
        array_to_vector(F.transform("x", lambda v, i: F.when(
            i == F.col("_s.at"), F.col("_s.grid_value")).otherwise(v))).alias("features"))
    scored = model.transform(copied)
    return scored.groupBy("feature", "grid_value").agg(
        F.avg(vector_to_array("probability")[1]).alias("average"))
