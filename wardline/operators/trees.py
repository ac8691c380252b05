"""Fitted tree ensembles as a table of nodes, and jobs that walk it.

A table has one row a node: ``(tree, node, feature, threshold, left, right, value)``. Node 0 is a tree's root; a row
whose feature is at most the threshold goes left; a leaf has feature -1 and points to itself. The table's size
is set by the fit's parameters (trees x 2 ** (depth + 1) at most), not by the rows.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.session import work_path

# Executors get these functions with the job and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, value double"
FOREST, BOOSTING = "forest", "boosting"
#: Rows walked through all trees at once.
WALKED = 1_000


class Trees(NamedTuple):
    """A table of nodes. The value of a forest is the mean of its leaves, a share of class 1; that of a boosted
    ensemble the sum, half the log odds."""

    nodes: DataFrame
    kind: str
    trees: int
    depth: int


def literal_trees(spark: SparkSession, rows: Sequence[tuple], kind: str = FOREST) -> Trees:
    """Trees from rows of the table."""
    places = {(r[0], r[1]): r for r in rows}
    def below(r) -> int:
        return 0 if r[2] < 0 else 1 + max(below(places[r[0], r[4]]), below(places[r[0], r[5]]))
    roots = [r for r in rows if r[1] == 0]
    return Trees(spark.createDataFrame(list(rows), SCHEMA), kind, len(roots), max(map(below, roots), default=0))


def tree_table(model) -> Trees:
    """The nodes of a fitted forest or boosted ensemble, from its stored form. Splits on categories are not
    thresholds; a model that has them raises ``ValueError``."""
    boosted = isinstance(model, GBTClassificationModel)
    if not boosted and not isinstance(model, RandomForestClassificationModel):
        raise ValueError("not an ensemble of trees")
    spark = SparkSession.getActiveSession()
    path = work_path(spark, "trees")
    model.write().save(path)
    stored = spark.read.parquet(f"{path}/data")
    tree, data = stored.columns[:2]
    n = stored.select(F.col(tree).cast("int").alias("tree"), f"{data}.*")
    if not n.where("split.numCategories >= 0").isEmpty():
        raise ValueError("the model splits on categories")
    weights = F.array(*[F.lit(float(w)) for w in model.treeWeights])
    value = (F.col("prediction") * F.get(weights, F.col("tree")) if boosted
             else F.get("impurityStats", F.lit(1)) / F.aggregate("impurityStats", F.lit(0.0), lambda a, b: a + b))
    leaf = F.col("leftChild") < 0
    nodes = n.select(
        "tree", F.col("id").alias("node"), F.when(leaf, -1).otherwise(F.col("split.featureIndex")).alias("feature"),
        F.when(leaf, 0.0).otherwise(F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.when(leaf, F.col("id")).otherwise(F.col("leftChild")).alias("left"),
        F.when(leaf, F.col("id")).otherwise(F.col("rightChild")).alias("right"), value.alias("value"))
    return Trees(nodes, BOOSTING if boosted else FOREST, len(model.treeWeights), model.getMaxDepth())


def probability(trees: Trees, total):
    """Class 1's probability from the sum of a row's leaves."""
    return total / trees.trees if trees.kind == FOREST else 1.0 / (1.0 + F.exp(-2.0 * total))


def score_trees(rows: DataFrame, trees: Trees, key: str, vector: str = "x") -> DataFrame:
    """``(key, probability, prediction)`` by joins, a level of all trees at a time.

    A row is copied to every root, and the copies go down one node a join. The nodes are broadcast, so
    rows stay where they are; a row's leaves are added up before the only shuffle. ``vector`` is an array; a missing
    feature goes right. Keys must be unique.
    """
    stride = 1 << 32

    def place(node):
        return F.col("tree").cast("bigint") * stride + F.col(node)

    nodes = trees.nodes.select(place("node").alias("_node"), "feature", "threshold",
                               place("left").alias("_left"), place("right").alias("_right"))
    leaves = F.broadcast(trees.nodes.select(place("node").alias("_node"), "value"))
    at = rows.select(key, F.col(vector).alias("_x"), F.explode(F.sequence(F.lit(0), F.lit(trees.trees - 1))).alias("_tree"))
    at = at.select(key, "_x", (F.col("_tree").cast("bigint") * stride).alias("_node"))
    down = (F.when(F.col("feature") < 0, F.col("_node"))
            .when(F.get("_x", F.col("feature")) <= F.col("threshold"), F.col("_left")).otherwise(F.col("_right")))
    for _ in range(trees.depth):
        at = at.join(F.broadcast(nodes), "_node").select(key, "_x", down.alias("_node"))
    total = at.join(leaves, "_node").groupBy(key).agg(F.sum("value").alias("_total"))
    scored = total.select(key, probability(trees, F.col("_total")).alias("probability"))
    return scored.withColumn("prediction", (F.col("probability") > 0.5).cast("double"))


class _Arrays(NamedTuple):
    """All trees in one set of arrays; ``left`` and ``right`` are places in them."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray


def _arrays(trees: Trees) -> _Arrays:
    table = trees.nodes.toPandas().sort_values(["tree", "node"], ignore_index=True)
    places = {name: k for k, name in enumerate(zip(table["tree"], table["node"]))}
    def to(column):
        return np.array([places[name] for name in zip(table["tree"], table[column])])
    return _Arrays(np.flatnonzero(table["node"] == 0), table["feature"].to_numpy(), table["threshold"].to_numpy(),
                   to("left"), to("right"), table["value"].to_numpy())


def thresholds(a: _Arrays, feature: int) -> np.ndarray:
    return np.unique(a.threshold[a.feature == feature])


def values_by_interval(x: np.ndarray, a: _Arrays, feature: int, cuts: np.ndarray) -> np.ndarray:
    """For every row the sum of its leaves as a step function of ``feature``: one value for each interval between
    the ensemble's cuts. A row goes through a tree once, both ways where the feature is asked for, so that the leaves
    it reaches split the feature's range; a leaf adds to where its interval begins and takes away where it ends."""
    n, width = len(x), len(cuts) + 1
    steps = np.zeros(n * (width + 1))
    row = np.repeat(np.arange(n), len(a.roots))
    node = np.tile(a.roots, n)
    low, high = np.zeros(len(row), np.int64), np.full(len(row), width - 1)
    cut_at = np.searchsorted(cuts, a.threshold)
    while len(row):
        asked = a.feature[node]
        leaf = asked < 0
        if leaf.any():
            base, value = row[leaf] * (width + 1), a.value[node[leaf]]
            steps += np.bincount(base + low[leaf], value, minlength=len(steps))
            steps -= np.bincount(base + high[leaf] + 1, value, minlength=len(steps))
            row, node, low, high, asked = row[~leaf], node[~leaf], low[~leaf], high[~leaf], asked[~leaf]
        both = asked == feature
        cut = cut_at[node]
        go_left = np.where(both, low <= cut, x[row, asked] <= a.threshold[node])
        go_right = np.where(both, high > cut, ~go_left)
        left, right = np.flatnonzero(go_left), np.flatnonzero(go_right)
        row, node, low, high = (
            np.concatenate([row[left], row[right]]), np.concatenate([a.left[node[left]], a.right[node[right]]]),
            np.concatenate([low[left], np.where(both[right], np.maximum(low[right], cut[right] + 1), low[right])]),
            np.concatenate([np.where(both[left], np.minimum(high[left], cut[left]), high[left]), high[right]]))
    return np.cumsum(steps.reshape(n, width + 1)[:, :width], axis=1)


def mean_by_interval(rows: DataFrame, trees: Trees, places: Sequence[int], vector: str = "features") -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For every place in the vector ``(cuts, means)``: the mean probability of all rows with that feature set to a
    value of each interval between the cuts (a value equal to a cut is in the interval below it).

    Exact for every value at once; each row is read once and sends nothing but its partition's sums.
    """
    a, forest = _arrays(trees), trees.kind == FOREST
    cuts = {f: thresholds(a, f) for f in places}
    n_trees = trees.trees

    def sums(batches):
        totals, n = {f: np.zeros(len(c) + 1) for f, c in cuts.items()}, 0
        for batch in batches:
            column = batch.column(0)
            x = np.stack(column.to_numpy(zero_copy_only=False)) if len(column) else np.zeros((0, 1))
            n += len(x)
            for start in range(0, len(x), WALKED):
                part = x[start : start + WALKED]
                for f, c in cuts.items():
                    value = values_by_interval(part, a, f, c)
                    totals[f] += (value / n_trees if forest else 1.0 / (1.0 + np.exp(-2.0 * value))).sum(axis=0)
        fs = [f for f, t in totals.items() for _ in t] + [-1]
        spots = [i for t in totals.values() for i in range(len(t))] + [0]
        yield pa.RecordBatch.from_arrays([pa.array(fs, pa.int32()), pa.array(spots, pa.int32()),
                                          pa.array(np.concatenate([*totals.values(), [float(n)]]))], ["feature", "spot", "total"])

    found = (rows.select(vector_to_array(vector).alias("x") if vector == "features" else F.col(vector).alias("x"))
             .mapInArrow(sums, "feature int, spot int, total double")
             .groupBy("feature", "spot").agg(F.sum("total").alias("total")).collect())
    by = {(r["feature"], r["spot"]): r["total"] for r in found}
    n = by.get((-1, 0), 0.0)
    if not n:
        return {}
    return {f: (c, np.array([by[f, i] for i in range(len(c) + 1)]) / n) for f, c in cuts.items()}
