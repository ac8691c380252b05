"""Balancing, neighbours, fitted models and their explanation."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.operators import balance, evaluate, explain, model, neighbours, score, trees, vector_index
from wardline.plans import stages
from wardline.plans.catalogue.cleaning import rounded
from wardline.plans.catalogue.scoring import scoring_inputs
from wardline.plans.model_table import model_columns, scaled_split, split_rows
from wardline.sources.encounters import table
from wardline.session import work_path
from wardline.sources.layout import KEY

# Whole-number columns, so distances are exact on every engine.
WHOLE = ["time_in_hospital", "num_lab_procedures", "num_medications", "number_inpatient",
         "number_diagnoses", "age_midpoint"]

# A small forest over them: tree, node, feature, threshold, left, right, share of class 1.
TREES = [
    (0, 0, 3, 0.5, 1, 2, 0.0), (0, 1, 0, 4.0, 3, 4, 0.0), (0, 2, 4, 7.0, 5, 6, 0.0), (0, 3, -1, 0.0, 3, 3, 0.125),
    (0, 4, 1, 60.0, 7, 8, 0.0), (0, 5, -1, 0.0, 5, 5, 0.375), (0, 6, -1, 0.0, 6, 6, 0.75), (0, 7, -1, 0.0, 7, 7, 0.25), (0, 8, -1, 0.0, 8, 8, 0.5),
    (1, 0, 1, 45.5, 1, 2, 0.0), (1, 1, -1, 0.0, 1, 1, 0.125), (1, 2, 1, 75.0, 3, 4, 0.0), (1, 3, 0, 6.0, 5, 6, 0.0),
    (1, 4, -1, 0.0, 4, 4, 0.625), (1, 5, -1, 0.0, 5, 5, 0.25), (1, 6, -1, 0.0, 6, 6, 0.875),
    (2, 0, -1, 0.0, 0, 0, 0.25),
    (3, 0, 2, 15.0, 1, 2, 0.0), (3, 1, 3, 1.0, 3, 4, 0.0), (3, 2, 0, 3.0, 5, 6, 0.0), (3, 3, -1, 0.0, 3, 3, 0.0),
    (3, 4, -1, 0.0, 4, 4, 0.5), (3, 5, -1, 0.0, 5, 5, 0.375), (3, 6, -1, 0.0, 6, 6, 1.0),
]


def _train(spark, folder):
    return split_rows(spark, folder).where(F.col("split") == "train").select(
        KEY, *WHOLE, "label")


def balanced(spark, folder):
    return stages.once(
        spark, folder, "balanced",
        lambda: balance.balance(_train(spark, folder), KEY, "label", WHOLE))


def ml03_synthetic_minority(spark, folder):
    return rounded(balanced(spark, folder).where("copy > 0"))


def set03_balanced_rows(spark, folder):
    return rounded(balanced(spark, folder))


def agg18_class_change(spark, folder):
    return balance.class_change(_train(spark, folder), balanced(spark, folder), "label")


def jn08_minority_neighbours(spark, folder):
    rows = _train(spark, folder).where("label = 1").select(
        KEY, F.array(*WHOLE).alias("x"))
    return neighbours.nearest_neighbours(rows, KEY, "x", 5)


def jn08_minority_neighbours_many_cells(spark, folder):
    """The same answer from small cells, which makes rows visit other cells."""
    rows = _train(spark, folder).where("label = 1").select(KEY, F.array(*WHOLE).alias("x"))
    return neighbours.nearest_neighbours(rows, KEY, "x", 5, cell_rows=100)


def jn08_embedding_neighbours(spark, folder):
    rows = table(spark, folder, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("x"))
    return rounded(neighbours.nearest_neighbours(rows, "vec_id", "x", 5, cell_rows=100))


def _embeddings(spark, folder):
    return table(spark, folder, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))


def jn08_indexed_neighbours(spark, folder):
    """Neighbours of all embeddings among the rows of the lists that the index looks into."""
    return rounded(vector_index.indexed_neighbours(_embeddings(spark, folder), "vec_id", "x", 5))


def jn08_index_recall(spark, folder):
    """How many true neighbours there are, and whether the index finds nine in ten of them."""
    rows = _embeddings(spark, folder)
    found = vector_index.indexed_neighbours(rows, "vec_id", "x", 5)
    exact = neighbours.nearest_neighbours(rows, "vec_id", "x", 5)
    return vector_index.recall_of(found, exact, "vec_id").select(
        "n", (F.col("n_found") >= 0.9 * F.col("n")).alias("enough"))


def fitted(spark, folder):
    """Models on the scaled training rows: (models, feature names)."""
    def build():
        rows = scaled_split(spark, folder)[0]
        features = model_columns(rows)
        train = model.kept_for_fit(rows.where(F.col("split") == "train"), features)
        models = {
            "Gradient Boosting": model.fit_boosting(train, features),
            "Logistic Regression": model.fit_logistic(train, features),
            "Random Forest": model.fit_forest(train, features),
        }
        train.unpersist()
        return models, features

    return stages.once(spark, folder, "fitted", build)


def _test(spark, folder):
    return scaled_split(spark, folder)[0].where(F.col("split") == "test")


def ml04_fitted_models(spark, folder):
    """Training-set metrics of the three fitted models."""
    models, features = fitted(spark, folder)
    rows = scaled_split(spark, folder)[0].where(F.col("split") == "train")
    return evaluate.compare_models(model.predict_all(models, rows, features, KEY))


def ml05_predictions(spark, folder):
    models, features = fitted(spark, folder)
    return model.predict_all(models, _test(spark, folder), features, KEY)


def ml12_fitted_comparison(spark, folder):
    return evaluate.compare_models(ml05_predictions(spark, folder))


def ml14_impurity_importance(spark, folder):
    models, features = fitted(spark, folder)
    return explain.impurity_importance(
        _test(spark, folder), models["Random Forest"], features)


def top05_strongest_importances(spark, folder):
    return explain.strongest_importances(ml14_impurity_importance(spark, folder), "importance")


def ml15_permutation_importance(spark, folder):
    models, features = fitted(spark, folder)
    return explain.permutation_importance(
        models["Random Forest"], _test(spark, folder), features, KEY)


def ml16_partial_dependence(spark, folder):
    models, features = fitted(spark, folder)
    top = [r["feature"] for r in ml14_impurity_importance(spark, folder).limit(
        explain.TOP_DEPENDENCE).collect()]
    return explain.partial_dependence(
        models["Random Forest"], _test(spark, folder), features, top)


def _plain_test(spark, folder):
    return split_rows(spark, folder).where(F.col("split") == "test").select(KEY, "label", *WHOLE)


def ml05_tree_table_predictions(spark, folder):
    """The test rows through a forest that is given as a table of nodes."""
    rows = _plain_test(spark, folder).select(KEY, F.array(*[F.col(c).cast("double") for c in WHOLE]).alias("x"))
    return trees.score_trees(rows, trees.literal_trees(spark, TREES), KEY)


def ml05_fitted_forest_and_its_nodes(spark, folder):
    """On how many test rows the fitted forest's own predictions and those of its nodes agree."""
    models, features = fitted(spark, folder)
    rows = _test(spark, folder)
    own = model.predict(models["Random Forest"], rows, features, "Random Forest", KEY)
    table = trees.score_trees(rows.select(KEY, F.array(*[F.col(c).cast("double") for c in features]).alias("x")),
                              trees.tree_table(models["Random Forest"]), KEY)
    same = (F.abs(F.col("y_prob") - F.col("probability")) < 1e-9) & (F.col("y_pred") == F.col("prediction"))
    # A side with a row an encounter is not broadcast, however small its files are.
    return own.join(table.hint("merge"), KEY, "left").agg(F.count("*").alias("n"), F.count_if(same).alias("n_same"))


def ml16_tree_table_dependence(spark, folder):
    """Average predictions of the same forest over the test rows, by length of stay and by laboratory procedures."""
    made = explain.partial_dependence(
        trees.literal_trees(spark, TREES), _plain_test(spark, folder), WHOLE, ["time_in_hospital", "num_lab_procedures"])
    return made.select("feature", F.round("grid_value", 9).alias("grid_value"), F.round("average", 9).alias("average"))


def scr03_tree_table_score(spark, folder):
    """Scores of all inputs by the forest of the table."""
    inputs = score.model_inputs(scoring_inputs(spark, folder))
    vectors = inputs.select(KEY, F.array(*[F.col(c).cast("double") for c in WHOLE]).alias("x"))
    probable = trees.score_trees(vectors, trees.literal_trees(spark, TREES), KEY).select(KEY, "probability")
    return score.with_model_score(inputs.select(KEY, "patient_name").join(probable.hint("merge"), KEY)).select(KEY, "risk_score")


def _scorer(spark, folder):
    models, features = fitted(spark, folder)
    return model.Scorer(models["Random Forest"], dict(scaled_split(spark, folder)[1]), list(features))


def scr03_model_score(spark, folder):
    """Scores of all inputs by the fitted forest."""
    return score_with(_scorer(spark, folder), scoring_inputs(spark, folder))


def score_with(scorer, inputs):
    """Each input's score: the model's where there is one and all its columns are known, else the
    rule-based one, to which a missing number counts as zero."""
    known = inputs.fillna(0, [c for c, t in inputs.dtypes if c != KEY and t in ("int", "bigint", "double")])
    ruled = score.with_rule_score(known).select(KEY, F.col("risk_score").alias("_rule"))
    if scorer is None:
        return ruled.select(KEY, F.col("_rule").alias("risk_score"))
    probable = model.probability(scorer, score.model_inputs(inputs)).select(KEY, "patient_name", "probability")
    scored = score.with_model_score(probable.where("probability is not null")).select(KEY, "risk_score")
    return ruled.join(scored.hint("merge"), KEY, "left").select(KEY, F.coalesce("risk_score", "_rule").alias("risk_score"))


def scr04_fallback_score(spark, folder):
    """Scores where no model is stored."""
    stored = model.load_scorer(spark, work_path(spark, "no-scorer"))
    return score_with(stored, scoring_inputs(spark, folder))


def scr04_stored_model_score(spark, folder):
    """Scores by the model, scaler and feature order that were stored together; every hundredth
    input lacks its length of stay and gets the rule-based one."""
    path = stages.once(spark, folder, "scorer", lambda: _stored(spark, folder))
    inputs = scoring_inputs(spark, folder)
    gaps = inputs.withColumn("time_in_hospital", F.when(F.col(KEY) % 100 != 0, F.col("time_in_hospital")))
    return score_with(model.load_scorer(spark, path), gaps)


def _stored(spark, folder):
    path = work_path(spark, "scorer")
    model.save_scorer(spark, _scorer(spark, folder), path)
    return path


QUERIES = {f.__name__: f for f in (
    ml03_synthetic_minority, set03_balanced_rows, agg18_class_change,
    jn08_minority_neighbours, jn08_minority_neighbours_many_cells,
    jn08_embedding_neighbours, jn08_indexed_neighbours, jn08_index_recall, ml04_fitted_models, ml05_predictions,
    ml12_fitted_comparison, ml14_impurity_importance, top05_strongest_importances,
    ml15_permutation_importance, ml16_partial_dependence, ml05_tree_table_predictions,
    ml05_fitted_forest_and_its_nodes, ml16_tree_table_dependence, scr03_model_score, scr03_tree_table_score,
    scr04_fallback_score, scr04_stored_model_score,
)}
