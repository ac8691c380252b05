"""Tree tables, partial dependence and the Newton fit against plain versions."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from wardline.operators import explain, model, trees
from wardline.operators.logistic import newton
from wardline.plans import stages
from wardline.plans.model_table import model_columns, scaled_split

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(11)
    out = []
    for k in range(1500):
        a, b, c, d = rng.random(), rng.randrange(5), rng.gauss(0, 3), float(k % 2)
        out.append((k, a, float(b), c, d, int(a * b + c / 4 + rng.random() > 1.5)))
    return spark.createDataFrame(out, "id long, a double, b double, c double, d double, label int").cache()


@pytest.fixture(scope="module")
def fitted(rows):
    return {"forest": model.fit_forest(rows, FEATURES, trees=12, depth=5),
            "boosting": model.fit_boosting(rows, FEATURES, trees=8, depth=3, step=0.3)}


@pytest.mark.parametrize("name", ["forest", "boosting"])
def test_table_predicts_like_the_model(rows, fitted, name):
    fit = fitted[name]
    vectors = rows.select("id", F.array(*FEATURES).alias("x"))
    table = {r.id: r for r in trees.score_trees(vectors, trees.tree_table(fit), "id").collect()}
    own = fit.transform(model.assemble(rows, FEATURES)).select("id", "prediction", vector_to_array("probability")[1].alias("p")).collect()
    assert len(table) == len(own) == 1500
    assert all(table[r.id].prediction == r.prediction and abs(table[r.id].probability - r.p) < 1e-12 for r in own)


def test_scoring_moves_no_rows_before_the_sums(rows, fitted):
    vectors = rows.select("id", F.array(*FEATURES).alias("x"))
    plan = trees.score_trees(vectors, trees.tree_table(fitted["forest"]), "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 6 and "SortMergeJoin" not in plan and plan.count("hashpartitioning") == 1


@pytest.mark.parametrize("name", ["forest", "boosting"])
def test_dependence_equals_that_of_copies(rows, fitted, name):
    fit, columns = fitted[name], ["a", "b", "c"]
    got = {(r.feature, r.grid_value): r.average for r in explain.partial_dependence(fit, rows, FEATURES, columns).collect()}
    want = explain.dependence_by_copies(fit, rows, FEATURES, explain.dependence_grid(rows, columns)).collect()
    assert len(got) == len(want) == 50 + 5 + 50
    assert all(abs(got[r.feature, r.grid_value] - r.average) < 1e-9 for r in want)


def test_dependence_at_values_equal_to_thresholds_and_beyond(spark, rows):
    """Stumps: a value equal to the threshold goes left; splits on other columns follow the row."""
    nodes = [(0, 0, 0, 0.5, 1, 2, 0.0), (0, 1, -1, 0.0, 1, 1, 0.2), (0, 2, 1, 1.0, 3, 4, 0.0), (0, 3, -1, 0.0, 3, 3, 0.4), (0, 4, 0, 0.7, 5, 6, 0.0),
             (0, 5, -1, 0.0, 5, 5, 0.6), (0, 6, -1, 0.0, 6, 6, 1.0), (1, 0, -1, 0.0, 0, 0, 0.5)]
    table = trees.literal_trees(spark, nodes)
    assert (table.trees, table.depth) == (2, 3)
    few = spark.createDataFrame([(0, [0.1, 1.0]), (1, [0.9, 2.0]), (2, [0.6, 3.0])], "id long, x array<double>")
    (cuts, means) = trees.mean_by_interval(few, table, [0], "x")[0]
    assert cuts.tolist() == [0.5, 0.7]
    assert np.allclose(means, [(0.2 + 0.5) / 2, (0.4 + 0.6 + 0.6 + 1.5) / 6, (0.4 + 1.0 + 1.0 + 1.5) / 6])
    assert {r.id: round(r.probability, 9) for r in trees.score_trees(few, table, "id").collect()} == {0: 0.35, 1: 0.75, 2: 0.55}
    assert trees.mean_by_interval(few.limit(0), table, [0], "x") == {}


def test_missing_feature_goes_right(spark):
    table = trees.literal_trees(spark, [(0, 0, 0, 0.5, 1, 2, 0.0), (0, 1, -1, 0.0, 1, 1, 0.0), (0, 2, -1, 0.0, 2, 2, 1.0)])
    rows = spark.createDataFrame([(1, [0.2]), (2, [None])], "id long, x array<double>")
    assert {r.id: r.prediction for r in trees.score_trees(rows, table, "id").collect()} == {1: 0.0, 2: 1.0}


def test_other_models_are_scored_by_copies(rows):
    fit = model.fit_logistic(rows, FEATURES)
    got = explain.partial_dependence(fit, rows, FEATURES, ["b"]).collect()
    want = {r.grid_value: r.average for r in explain.dependence_by_copies(fit, rows, FEATURES, {"b": [0.0, 1.0, 2.0, 3.0, 4.0]}).collect()}
    assert {r.grid_value: r.average for r in got} == want


def plain_newton(x, y, c, steps=50):
    x = np.column_stack([x, np.ones(len(x))])
    beta, penalty = np.zeros(x.shape[1]), np.append(np.full(x.shape[1] - 1, 1 / c), 0)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ beta))
        beta -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * beta)
    return beta


def penalised_loss(x, y, weights, intercept, c):
    m = x @ np.asarray(weights) + intercept
    return (np.logaddexp(0, m) - y * m).sum() + (np.asarray(weights) ** 2).sum() / (2 * c)


def test_logistic_fit_against_numpy_and_the_library(spark):
    folder = "/root/testdata/sf0.01"
    table = scaled_split(spark, folder)[0]
    features = model_columns(table)
    train = model.kept_for_fit(table.where(F.col("split") == "train"), features)
    fit = model.fit_logistic(train, features)
    got = train.select(vector_to_array("features").alias("x"), "label").toPandas()
    x, y = np.stack(got["x"]), got["label"].to_numpy(float)
    want = plain_newton(x, y, 1.0)
    assert np.abs(np.append(fit.coefficients, fit.intercept) - want).max() < 1e-6 and fit.scans < 10
    other = LogisticRegression(labelCol="label", regParam=1.0 / len(y), maxIter=1000, tol=1e-4, standardization=False).fit(train)
    ours = penalised_loss(x, y, fit.coefficients, fit.intercept, 1.0)
    assert ours <= penalised_loss(x, y, other.coefficients.toArray(), other.intercept, 1.0) + 1e-9
    train.unpersist()


def test_newton_halves_steps_and_bears_edges(spark):
    # Far out, the first full steps overshoot: rows of very different scale and weak penalty.
    data = [([1e4], 1.0), ([-1e4], 0.0), ([1.0], 0.0), ([-1.0], 1.0), ([2.0], 1.0)]
    rows = spark.createDataFrame(data, "x array<double>, y double")
    fit, far = newton(rows, 1, 1e3, 1e-4, 200), newton(rows, 1, 1e3, 1e-4, 200, sample=0)
    assert np.allclose(fit.coefficients + (fit.intercept,), far.coefficients + (far.intercept,), atol=1e-6) and fit.scans < far.scans
    x, y = np.array([d[0] for d in data]), np.array([d[1] for d in data])
    around = [penalised_loss(x, y, [fit.coefficients[0] + d], fit.intercept + e, 1e3) for d in (-1e-6, 0, 1e-6) for e in (-1e-3, 0, 1e-3)]
    assert penalised_loss(x, y, fit.coefficients, fit.intercept, 1e3) <= min(around) + 1e-9
    assert newton(rows.limit(0), 1, 1.0, 1e-4, 50).coefficients == (0.0,)
    one = newton(rows.where("y = 1"), 1, 1.0, 1e-4, 50)
    assert one.intercept > 5


def test_fit_survives_storage(spark, rows, tmp_path):
    fit = model.fit_logistic(rows, FEATURES)
    model.save(fit, f"{tmp_path}/m")
    again = model.load(f"{tmp_path}/m")
    assert (again.coefficients, again.intercept) == (fit.coefficients, fit.intercept)


def test_training_rows_are_dealt_evenly(spark, monkeypatch):
    """Parts of 9,000, 1, 1 and 1 rows become even ones; a table of few rows keeps its parts."""
    monkeypatch.setattr(model, "ROWS_A_TASK", 1_000, raising=False)
    uneven = spark.range(0, 9_000, 1, 1).union(spark.range(0, 3, 1, 3)).select(F.col("id").cast("double").alias("a"), (F.col("id") % 2).alias("label"))

    def sizes(df):
        kept = model.kept_for_fit(df, ["a"])
        found = kept.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
        kept.unpersist()
        return found

    even = sizes(uneven)
    assert sum(even) == 9_003 and len(even) >= 4 and max(even) - min(even) < 100
    assert sizes(uneven.where("a < 500")) == [500, 1, 1, 1]
