"""Evaluation, scoring, records, streams and explanations on small tables."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardline.operators import evaluate, explain, model, records, score
from wardline.session import work_path
from wardline.streaming import jobs


@pytest.fixture(scope="module")
def predictions(spark):
    rng = np.random.default_rng(11)
    rows = []
    for name in ("A", "B"):
        for i in range(600):
            y = int(rng.random() < 0.2)
            # Few distinct scores make ties; one of them is shared by a third of the rows.
            p = 0.5 if i % 3 == 0 else round(float(np.clip(rng.normal(0.4 + 0.2 * y, 0.2), 0, 1)), 2)
            rows.append((name, i, y, int(p > 0.5), p))
    return spark.createDataFrame(rows, "model string, k bigint, label int, y_pred int, y_prob double")


def pairs_auc(rows):
    pos = [r.y_prob for r in rows if r.label == 1]
    neg = [r.y_prob for r in rows if r.label == 0]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("limit", [1_000_000, 20])
def test_area_counts_pairs(predictions, limit):
    got = {r.model: r.roc_auc for r in evaluate.roc_auc(
        evaluate.score_steps(predictions, one_task_rows=limit)).collect()}
    for name in ("A", "B"):
        rows = predictions.where(F.col("model") == name).collect()
        assert got[name] == pytest.approx(pairs_auc(rows), abs=1e-12)


def test_curve_ends_at_one(predictions):
    points = evaluate.roc_curve(evaluate.score_steps(predictions)).where("model = 'A'").collect()
    last = max(points, key=lambda r: (r.fpr, r.tpr))
    assert last.fpr == 1.0 and last.tpr == 1.0


def test_metrics(predictions):
    rows = predictions.where("model = 'A'").collect()
    y = np.array([r.label for r in rows])
    p = np.array([r.y_prob for r in rows])
    got = evaluate.probability_scores(predictions).where("model = 'A'").first()
    assert got.brier == pytest.approx(((y - p) ** 2).mean())
    assert got.r2 == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())


def test_no_positive_prediction_scores_zero(spark):
    df = spark.createDataFrame([("A", 1, 0), ("A", 0, 0)], "model string, label int, y_pred int")
    got = evaluate.rates(evaluate.confusion(df)).first()
    assert (got.accuracy, got.precision, got.recall, got.f1) == (0.5, 0.0, 0.0, 0.0)


def test_three_way_tie_goes_to_the_larger_area(spark):
    df = spark.createDataFrame(
        [("F", .65, .865), ("G", .6456, .8811), ("L", .6441, .8878)],
        "model string, roc_auc double, accuracy double")
    got = evaluate.best_models(df).first()
    assert (got.best_auc, got.best_accuracy, got.best_overall) == ("F", "L", "F")
    ranks = evaluate.average_rank(spark.createDataFrame(
        [("a", 1.0), ("b", 1.0), ("c", 2.0)], "model string, v double"), "v", "r")
    assert {r.model: r.r for r in ranks.collect()} == {"a": 2.5, "b": 2.5, "c": 1.0}


def inputs(spark):
    rows = [
        (1, "John Doe", datetime.datetime(2024, 1, 1), "60-70", 4, 44, 16, 0, 9, "No", True, False),
        (2, "Ann Lee", datetime.datetime(2024, 1, 2), "90-100", 14, 130, 80, 20, 16, "Up", False, True),
        (3, "Bo", datetime.datetime(2024, 1, 3), "0-10", 1, 1, 1, 0, 1, "Steady", True, False),
    ]
    return spark.createDataFrame(rows, (
        "encounter_id bigint, patient_name string, recorded_at timestamp, age string, "
        "time_in_hospital int, num_lab_procedures int, num_medications int, number_inpatient int, "
        "num_diagnoses int, insulin string, on_medication boolean, has_comorbidity boolean")
    ).withColumns({"phone": F.lit(""), "blood_group": F.lit("O+"),
                   "fasting_blood_sugar": F.lit(100), "gender": F.lit("Male")})


def test_rule_score(spark):
    import hashlib

    got = {r.encounter_id: r.risk_score for r in score.with_rule_score(inputs(spark)).collect()}
    noise = (int(hashlib.md5(b"John Doe").hexdigest(), 16) % 200 - 100) / 100
    assert noise == 0.88
    assert got[1] == round(12.5 + 22 * .4 + 4 * 1.8 + 44 * .12 + 16 * .35 + 5 * 2.5 + noise, 1)
    assert got[2] == 98.7
    assert got[3] > 5.2


def test_tiers_respect_the_side_of_each_bound(spark):
    df = spark.createDataFrame([(v,) for v in (24.9, 25.0, 25.1, 35.0, 35.1, 39.9, 40.0)], "v double")
    got = [r[0] for r in df.select(score.tier(F.col("v"), score.POLICIES["assessment"])).collect()]
    assert got == ["LOW", "MODERATE", "MODERATE", "MODERATE", "MODERATE", "MODERATE", "HIGH"]
    got = [r[0] for r in df.select(score.tier(F.col("v"), score.POLICIES["demonstration"])).collect()]
    assert got[:5] == ["LOW RISK", "LOW RISK", "MODERATE RISK", "MODERATE RISK", "CRITICAL / HIGH RISK"]


def test_topics(spark):
    texts = ["this one", "A headache and a STIFF NECK", "my heart", "meningitis", "zzz", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(
        score.topic(F.col("t"))).collect()]
    # The greeting word 'hi' sits inside 'this'; 'heart' before the rest.
    assert got == ["greeting", "meningitis", "cardiac", "unrecognised", "unrecognised", "unrecognised"]


def test_empty_feed_has_zero_totals_and_all_statuses(spark):
    empty = records.assemble(inputs(spark)).where("record_id < 0")
    assert tuple(records.totals(empty).first()) == (0, 0.0, 0)
    assert {tuple(r) for r in records.status_counts(empty).collect()} == {
        ("LOW", 0), ("MODERATE", 0), ("HIGH", 0)}


def test_merged_feed_keeps_each_record_once(spark):
    made = records.assemble(inputs(spark))
    stored, local = made.where("record_id <= 2"), made.where("record_id >= 2")
    got = records.merged_feed(stored, local).collect()
    assert [r.record_id for r in got] == [3, 2, 1]
    assert [r.record_id for r in records.merged_feed(stored, local, keep=1).collect()] == [3, 2]
    assert records.history_of(made, "ANN LEE").count() == 1


def test_stream_scores_like_the_batch(spark):
    source, out, state = (work_path(spark, n) for n in ("in", "out", "state"))
    batch = inputs(spark)
    batch.repartition(3).write.parquet(source)
    stream = jobs.read_stream(spark, source, batch.schema, files_per_batch=1)
    jobs.finish(jobs.append_to_files(jobs.score_stream(stream), out, state))
    want = {tuple(r) for r in records.assemble(batch).collect()}
    assert {tuple(r) for r in spark.read.parquet(out).collect()} == want
    # A second run over the same state adds nothing.
    jobs.finish(jobs.append_to_files(jobs.score_stream(
        jobs.read_stream(spark, source, batch.schema)), out, state))
    assert spark.read.parquet(out).count() == 3


def test_stream_drops_what_is_sent_again(spark):
    source, out, state = (work_path(spark, n) for n in ("in", "out", "state"))
    made = records.assemble(inputs(spark)).select("record_id", "timestamp", "status")
    for _ in range(2):
        made.coalesce(1).write.mode("append").parquet(source)
    stream = jobs.with_event_time(
        jobs.read_stream(spark, source, made.schema, 1), "timestamp", "30 days")
    jobs.finish(jobs.append_to_files(jobs.without_resent(stream), out, state))
    assert sorted(r.record_id for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_importances_find_the_feature_that_matters(spark):
    rng = np.random.default_rng(2)
    rows = [(i, float(a), float(b), float(c), int(a > 0.5))
            for i, (a, b, c) in enumerate(rng.random((400, 3)))]
    df = spark.createDataFrame(rows, "k bigint, a double, b double, c double, label int")
    names = ["a", "b", "c"]
    fitted = model.fit_forest(df, names, trees=5, depth=4)
    assert fitted.getNumTrees == 5
    assert explain.impurity_importance(df, fitted, names).first().feature == "a"
    table = explain.permutation_importance(fitted, df, names, "k", sample=200, repeats=3)
    got = {r.feature: r.importance_mean for r in table.collect()}
    assert got["a"] > 0.2 > max(abs(got["b"]), abs(got["c"]))
    curve = {r.grid_value: r.average for r in explain.partial_dependence(
        fitted, df, names, ["a"], points=10).collect()}
    assert len(curve) == 10
    assert curve[min(curve)] < 0.3 < 0.7 < curve[max(curve)]


def test_partial_dependence_is_the_mean_over_all_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(float(a), float(b), int(a + b > 1)) for a, b in rng.random((120, 2))]
    df = spark.createDataFrame(rows, "a double, b double, label int")
    fitted = model.fit_forest(df, ["a", "b"], trees=3, depth=3)
    grid = explain.dependence_grid(df, ["a"], 5)["a"]
    curve = {r.grid_value: r.average for r in explain.partial_dependence(
        fitted, df, ["a", "b"], ["a"], points=5).collect()}
    for value in grid:
        scored = model.predict(
            fitted, df.withColumn("a", F.lit(value)).withColumn("k", F.lit(0)), ["a", "b"], "m", "k")
        assert curve[value] == pytest.approx(scored.agg(F.avg("y_prob")).first()[0])


def test_save_and_load(spark):
    df = spark.createDataFrame([(float(i), i % 2) for i in range(40)], "a double, label int")
    fitted = model.fit_logistic(df, ["a"])
    path = work_path(spark, "model")
    model.save(fitted, path)
    assert model.load(path).coefficients == fitted.coefficients
