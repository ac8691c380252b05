"""Trees grown by scans against those of the library."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from wardline.operators import model, tree_scans, trees

FEATURES = ["a", "b", "c", "d", "e"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    out = []
    for k in range(6000):
        a, b, c, d = rng.random(), rng.randrange(5), rng.gauss(0, 3), float(rng.randrange(2))
        out.append((k, a, float(b), c, d, 1.0, int(a * b + c / 4 + rng.random() > 1.5)))
    made = spark.createDataFrame(out, "id long, a double, b double, c double, d double, e double, label int").repartition(3)
    return model.assemble(made, FEATURES).cache()


def shape_of(fit):
    """(depth, feature, threshold, gain) of inner nodes and what leaves hold, left before right."""
    out = []
    for t, tree in enumerate(fit.trees):
        def walk(node, depth):
            if node.subtreeDepth():
                split = node.split()
                out.append((t, depth, split.featureIndex(), round(split.threshold(), 9), round(node.gain(), 9)))
                walk(node.leftChild(), depth + 1)
                walk(node.rightChild(), depth + 1)
            else:
                out.append((t, depth, round(node.prediction(), 9), round(node.impurity(), 9)))
        walk(tree._call_java("rootNode"), 0)
    return out


def test_boosting_without_draws_equals_the_library(rows, monkeypatch):
    own = model.fit_boosting(rows, FEATURES, trees=6, depth=4, step=0.3, subsample=1.0)
    monkeypatch.setattr(model, "LIBRARY_ROWS", 100)
    monkeypatch.setattr(tree_scans, "BLOCK", 700)
    monkeypatch.setattr(tree_scans, "CHECKPOINT", 2)
    fit = model.fit_boosting(rows, FEATURES, trees=6, depth=4, step=0.3, subsample=1.0)
    assert shape_of(fit) == shape_of(own) and fit.treeWeights == own.treeWeights
    assert fit.getMaxDepth() == 4 and np.allclose(fit.featureImportances.toArray(), own.featureImportances.toArray())
    both = fit.transform(rows).select("id", vector_to_array("probability")[1].alias("p")).join(
        own.transform(rows).select("id", vector_to_array("probability")[1].alias("q")), "id")
    assert both.agg(F.count("*"), F.max(F.abs(F.col("p") - F.col("q")))).first()[1] < 1e-9


def test_a_tree_without_draws_equals_the_library(spark, rows):
    own = DecisionTreeClassifier(maxDepth=6, minInstancesPerNode=2, weightCol="weight").fit(model.with_class_weight(rows, "label"))
    n, ones = rows.count(), rows.where("label = 1").count()
    vectors = model._vectors(rows, "label")
    weights = [n / (2 * (n - ones)), n / (2 * ones)]
    cuts = tree_scans.find_cuts(vectors, n, weights, 1)
    grown = tree_scans.grow_forest(tree_scans.binned(vectors, cuts), cuts, 1, 6, 2, weights, 1, bootstrap=False)
    estimator = model.RandomForestClassifier(numTrees=1, maxDepth=6, minInstancesPerNode=2, weightCol="weight")
    fit = tree_scans.as_model(spark, estimator, grown, cuts)

    class One:
        trees = [own]
    assert shape_of(fit) == shape_of(One)


def test_a_forest_by_scans_is_one_of_the_library(rows, monkeypatch, tmp_path):
    own = model.fit_forest(rows, FEATURES, trees=30, depth=5)
    monkeypatch.setattr(model, "LIBRARY_ROWS", 100)
    monkeypatch.setattr(tree_scans, "GROUP", 8)
    fit = model.fit_forest(rows, FEATURES, trees=30, depth=5)
    again = model.fit_forest(rows, FEATURES, trees=30, depth=5)
    assert fit.getNumTrees == 30 and shape_of(fit) == shape_of(again)

    def hits(m):
        return m.transform(rows).where(F.col("prediction") == F.col("label")).count() / 6000
    assert abs(hits(fit) - hits(own)) < 0.01
    assert np.abs(fit.featureImportances.toArray() - own.featureImportances.toArray()).max() < 0.05
    # Every tree has a draw of its own, of about as many rows as there are; the constant feature is never split.
    roots = [n for n in shape_of(fit) if n[1] == 0]
    assert len(roots) == 30 and len({n[2:] for n in roots}) > 20 and 4 not in set(trees.tree_table(fit).nodes.toPandas()["feature"])
    model.save(fit, f"{tmp_path}/m")
    assert shape_of(model.load(f"{tmp_path}/m")) == shape_of(fit)


def test_draws_and_cuts():
    draws = tree_scans.poisson_table()
    assert len(draws) == 65_536 and abs(draws.mean() - 1) < 1e-4 and abs(draws.var() - 1) < 1e-3 and draws.max() >= 6
    assert tree_scans.cuts_of(np.array([3.0, 1.0, 1.0, 2.0]), np.ones(4)).tolist() == [1.5, 2.5]
    many = tree_scans.cuts_of(np.arange(1000.0), np.ones(1000))
    assert len(many) == 31 and np.diff(many).min() > 25


def test_bundles_give_each_feature_its_sums():
    bins = [2, 32, 5, 2, 31, 1, 4]
    by = tree_scans.bundles_of(bins, 64)
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.integers(0, b, 500) for b in bins]).astype(np.uint8)
    assert sorted(f for m in by.members for f in m) == list(range(7)) and len(by.members) < 7
    codes = np.frombuffer(tree_scans._first_state(by)((0, x.tobytes(), bytes(500)))[1], np.uint16).reshape(-1, 500)
    cells = np.stack([np.stack([np.bincount(c, minlength=tree_scans.CELLS)]) for c in codes])
    want = np.concatenate([np.bincount(x[:, f], minlength=b) for f, b in enumerate(bins)])
    assert tree_scans.by_feature(cells, by).tolist() == [want.tolist()]
