"""Evaluation on deterministic scores, rule scoring, the record feed, text routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.functions.codes import icd_number
from wardline.operators import evaluate, explain, records, score
from wardline.operators.features import glucose_category
from wardline.operators.ordering import order_statistics
from wardline.plans import stages
from wardline.plans.catalogue.cleaning import rounded
from wardline.plans.model_table import scaled_split, split_rows
from wardline.session import staged, work_path
from wardline.sources import files, store
from wardline.sources.encounters import encounters, table
from wardline.sources.layout import KEY

BLOOD_GROUPS = ["A+", "A-", "B+", "B-", "AB+", "AB-", "O+", "O-", "Unknown"]


def scoring_inputs(spark, folder):
    """A table of scoring inputs, one per encounter, named and dated."""
    raw = encounters(
        spark, folder,
        ("c_name AS patient_name", "o_orderdate AS recorded_at", "o_orderstatus AS origin"))
    main = icd_number(F.col("diag_1"))
    return raw.select(
        KEY, "patient_name", "recorded_at", "origin",
        F.concat(F.lit("+1-555-"), F.lpad((F.col("patient_nbr") % 10000).cast("string"), 4, "0"))
        .alias("phone"),
        F.translate("age", "[)", "").alias("age"), "gender",
        F.element_at(F.array(*map(F.lit, BLOOD_GROUPS)), (F.col(KEY) % 9 + 1).cast("int"))
        .alias("blood_group"),
        (F.col("num_lab_procedures") + 60).alias("fasting_blood_sugar"),
        "time_in_hospital", "num_lab_procedures", "num_medications", "number_inpatient",
        F.col("number_diagnoses").alias("num_diagnoses"), "insulin",
        (F.col("diabetesMed") == "Yes").alias("on_medication"),
        F.coalesce(main.between(390, 429) | main.between(580, 629), F.lit(False))
        .alias("has_comorbidity"),
        F.when(F.col("readmitted") == "<30", 1).otherwise(0).alias("label"),
    )


def scored(spark, folder):
    """Scored inputs, written once: later filters then read the score from files
    instead of being pushed below its arithmetic."""
    return stages.once(
        spark, folder, "scored",
        lambda: staged(score.with_rule_score(scoring_inputs(spark, folder)), "scored"))


def scored_records(spark, folder):
    return records.assemble(scored(spark, folder))


def predictions(spark, folder):
    """Three deterministic scores as models, in long form."""
    based = scored(spark, folder).select(
        KEY, "label",
        F.explode(F.array(
            F.struct(F.lit("Rule Score").alias("model"),
                     (F.col("risk_score") / 100).alias("y_prob")),
            F.struct(F.lit("Prior Admissions").alias("model"),
                     (F.least("number_inpatient", F.lit(8)) / 8).alias("y_prob")),
            F.struct(F.lit("Length Of Stay").alias("model"),
                     (F.col("time_in_hospital") / 14).alias("y_prob")),
        )).alias("_m"),
    ).select("_m.model", KEY, "label", "_m.y_prob")
    return based.withColumn("y_pred", (F.col("y_prob") > 0.5).cast("int"))


def ml06_confusion(spark, folder):
    return evaluate.confusion(predictions(spark, folder))


def ml07_rates(spark, folder):
    return rounded(evaluate.rates(evaluate.confusion(predictions(spark, folder))))


def ml08_roc_auc(spark, folder):
    return rounded(evaluate.roc_auc(evaluate.score_steps(predictions(spark, folder))))


def ml09_ml10_probability_scores(spark, folder):
    return rounded(evaluate.probability_scores(predictions(spark, folder)))


def ml11_roc_curve(spark, folder):
    return rounded(evaluate.roc_curve(evaluate.score_steps(predictions(spark, folder))))


def win03_score_steps(spark, folder):
    return rounded(evaluate.score_steps(predictions(spark, folder)))


def ml12_model_comparison(spark, folder):
    return evaluate.compare_models(predictions(spark, folder))


def ml13_best_models(spark, folder):
    return evaluate.best_models(evaluate.compare_models(predictions(spark, folder)))


def win01_average_ranks(spark, folder):
    return evaluate.ranked_models(evaluate.compare_models(predictions(spark, folder))).select(
        "model", "rank_auc", "rank_acc", "combined_rank")


def win02_rank_sum_winner(spark, folder):
    ranked = evaluate.ranked_models(evaluate.compare_models(predictions(spark, folder)))
    return ranked.orderBy("combined_rank", F.desc("roc_auc"), "model").limit(1).select(
        "model", "combined_rank")


def top03_arg_max(spark, folder):
    return evaluate.compare_models(predictions(spark, folder)).agg(
        F.min_by("model", F.struct(-F.col("brier"), F.col("model"))).alias("model"),
        F.max("brier").alias("brier"))


def ml17_f1_and_average_precision(spark, folder):
    made = predictions(spark, folder)
    return rounded(
        evaluate.weighted_f1(evaluate.confusion(made))
        .join(evaluate.average_precision(evaluate.score_steps(made)), "model"))


def win04_middle_row(spark, folder):
    rows = stages.prepared(spark, folder).select(KEY, "time_in_hospital", "readmitted")
    middle = order_statistics(rows, {"key": (F.col(KEY), rows.count() // 2)})["key"]
    return rows.where(F.col(KEY) == middle)


def win05_latest_per_patient(spark, folder):
    return records.latest_per_patient(
        scored_records(spark, folder).select(
            "record_id", "timestamp", "patient_name", "risk_score", "status"))


def srt03_extreme_rows(spark, folder):
    rows = stages.featured(spark, folder).select(KEY, "comorbidity_index", "length_of_stay_log")
    high = rows.orderBy(F.desc("comorbidity_index"), F.desc("length_of_stay_log"), KEY).limit(1)
    low = rows.orderBy("comorbidity_index", "length_of_stay_log", KEY).limit(1)
    return rounded(high.withColumn("which", F.lit("highest"))
                   .unionByName(low.withColumn("which", F.lit("lowest"))))


def scr01_rule_score(spark, folder):
    return score.with_rule_score(scoring_inputs(spark, folder)).select(KEY, "risk_score")


def scr01_rule_score_without_noise(spark, folder):
    return score.with_rule_score(scoring_inputs(spark, folder), noise=False).select(
        KEY, "risk_score")


def scr02_name_noise(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey", score.name_noise(F.col("c_name")).alias("noise"))


def scr05_risk_tiers(spark, folder):
    risk = scored(spark, folder).select(KEY, F.col("risk_score").alias("risk"))
    return risk.select(
        KEY, *[score.tier(F.col("risk") if name not in ("probability", "follow_up")
                          else F.col("risk") / 100, policy).alias(name)
               for name, policy in score.POLICIES.items()])


def scr06_recommendations(spark, folder):
    risk = scored(spark, folder).select(
        KEY, score.tier(F.col("risk_score"), score.POLICIES["demonstration"]).alias("category"),
        score.tier(F.col("risk_score"), score.POLICIES["assessment"]).alias("status"))
    advised = score.advise(risk, "category", score.RECOMMENDATIONS, "recommendation")
    return score.advise(advised, "status", score.FOLLOW_UPS, "follow_up")


def scr07_care_team(spark, folder):
    return score.allocate(
        table(spark, folder, "orders").select(
            "o_orderkey",
            F.when(F.col("o_orderstatus") == "F", "high")
            .when(F.col("o_orderstatus") == "O", "MODERATE").otherwise("other").alias("status"))
    ).select("o_orderkey", "status", "allocated_doctor", "contact")


def jn02_care_team_default(spark, folder):
    return score.allocate(
        table(spark, folder, "events").select("event_id", F.col("event_type").alias("status"))
    ).groupBy("status", "allocated_doctor").agg(F.count("*").alias("n"))


def scr08_records(spark, folder):
    return scored_records(spark, folder).withColumn(
        "timestamp", F.date_format("timestamp", "yyyy-MM-dd"))


def snk04_appended_records(spark, folder):
    """Two appends, one per origin, read back as one store."""
    inputs = scored(spark, folder)
    path = work_path(spark, "store")
    for test in (F.col("origin") == "F", F.col("origin") != "F"):
        records.append(records.assemble(inputs.where(test)), path)
    return files.read_snapshot(spark, path).select(
        "record_id", "patient_name", "risk_score", "status")


def _store(spark, folder):
    """A store that was filled by origin, older records first in another version, and got a batch twice."""
    def build():
        made = scored_records(spark, folder).withColumn("origin", F.col("record_id") % 3)
        path = work_path(spark, "record-store")
        early = made.where("origin = 0").withColumns({
            "risk_score": F.lit(0.0), "timestamp": F.col("timestamp") - F.expr("interval 40 days")})
        for batch in (early, made.where("origin < 2"), made.where("origin > 0"), made.where("origin > 0")):
            store.upsert(batch.drop("origin"), path, pattern=store.BY_MONTH)
        return path

    return stages.once(spark, folder, "record-store", build)


def snk04_upserted_records(spark, folder):
    """The store holds every record once, in its last version and under its month."""
    return store.read_store(spark, _store(spark, folder)).select(
        "record_id", "patient_name", "risk_score", "status", F.col("period").cast("int"))


def src05_newest_of_the_store(spark, folder):
    return store.newest(spark, _store(spark, folder), 100).select(
        "record_id", "patient_name", "risk_score", "status")


def scr09_merged_feed_of_the_store(spark, folder):
    """The newest 100 of the store, and the local records that are not among them."""
    made = scored(spark, folder)
    local = records.assemble(made.where(F.col("origin").isin("O", "P"))).drop("blood_group")
    return records.merged_feed(store.newest(spark, _store(spark, folder), 100), local).select(
        "record_id", "patient_name", "risk_score", "status", "blood_group")


def src05_newest_records(spark, folder):
    return records.newest(scored_records(spark, folder), 100).select(
        "record_id", "patient_name", "risk_score", "status")


def top04_newest_few(spark, folder):
    return records.newest(scored_records(spark, folder), 8).select("record_id", "risk_score")


def src06_sample_feed(spark, folder):
    """Display records of the first test rows, numbered in key order."""
    from pyspark.sql import Window as W

    ages = {i: f"{10 * i}-{10 * i + 10}" for i in range(10)}
    head = files.first_rows(
        split_rows(spark, folder).where(F.col("split") == "test")
        .select(KEY, "age", "num_lab_procedures", "number_inpatient", "time_in_hospital"),
        KEY, 120)
    numbered = head.withColumn("position", F.row_number().over(W.orderBy(KEY)) - 1)
    return score.allocate(score.sample_feed(numbered, ages)).drop("specialty", "contact")


def _both_stores(spark, folder):
    made = scored(spark, folder)
    stored = records.assemble(made.where(F.col("origin").isin("F", "O")))
    local = records.assemble(made.where(F.col("origin").isin("O", "P")))
    return stored, local.drop("blood_group")


def scr09_merged_feed(spark, folder):
    return records.merged_feed(*_both_stores(spark, folder)).select(
        "record_id", "patient_name", "risk_score", "status", "blood_group")


def jn05_unseen_records(spark, folder):
    stored, local = _both_stores(spark, folder)
    return local.join(stored.select("record_id").hint("merge"), "record_id", "left_anti").select(
        "record_id", "patient_name")


def set01_union(spark, folder):
    stored, local = _both_stores(spark, folder)
    return stored.unionByName(local, allowMissingColumns=True).select(
        "record_id", "risk_score", "blood_group")


def scr10_feed_display(spark, folder):
    return records.display(scored_records(spark, folder))


def flt05_status_filter(spark, folder):
    return records.with_status(scored_records(spark, folder), "HIGH").select(
        "record_id", "status")


def flt06_patient_history(spark, folder):
    return records.history_of(scored_records(spark, folder), "CUSTOMER#000000077").select(
        "record_id", "patient_name", "risk_score")


def snk05_history_export(spark, folder):
    shown = records.display(records.with_status(scored_records(spark, folder), "MODERATE"))
    path = work_path(spark, "history-csv")
    files.write_csv(shown, path)
    return files.read_typed_csv(spark, path, shown.schema)


def agg15_feed_totals(spark, folder):
    return records.totals(scored_records(spark, folder))


def agg16_status_counts(spark, folder):
    return records.status_counts(scored_records(spark, folder))


def agg16_other_statuses(spark, folder):
    return records.status_counts(
        table(spark, folder, "events").select(F.col("event_type").alias("status")))


def scr11_example_picks(spark, folder):
    """Highest, middle and lowest complexity rows of the scaled test split."""
    test = scaled_split(spark, folder)[0].where(F.col("split") == "test").select(
        KEY, "comorbidity_index", "length_of_stay_log")
    middle = order_statistics(test, {"key": (F.col(KEY), test.count() // 2)})["key"]
    first = test.orderBy(F.desc("comorbidity_index"), F.desc("length_of_stay_log"), KEY).limit(1)
    last = test.orderBy("comorbidity_index", "length_of_stay_log", KEY).limit(1)
    picks = (
        first.withColumn("example", F.lit("complex"))
        .unionByName(test.where(F.col(KEY) == middle).withColumn("example", F.lit("standard")))
        .unionByName(last.withColumn("example", F.lit("low complexity"))))
    return rounded(picks.withColumn("days", F.exp("length_of_stay_log")))


def _with_probability(spark, folder):
    return scored(spark, folder).select(
        KEY, "label", F.col("recorded_at").alias("timestamp"),
        (F.col("risk_score") / 100).alias("probability"))


def scr12_follow_up_list(spark, folder):
    return rounded(records.follow_up_list(_with_probability(spark, folder)).drop("timestamp"))


def scr12_cohort_trend(spark, folder):
    return rounded(records.cohort_trend(_with_probability(spark, folder)))


def fe49_scoring_columns(spark, folder):
    return rounded(score.model_inputs(scoring_inputs(spark, folder)))


def prj05_default_columns(spark, folder):
    return score.model_inputs(scoring_inputs(spark, folder)).select(
        KEY, "race", "admission_source_id", "num_procedures", "discharge_disposition_risk",
        "emergency_elderly")


def jn07_rows_by_grid(spark, folder):
    """Mean rule score when every row takes each grid value of one input in turn.

    The grid is a short literal list per row, so no join is needed.
    """
    inputs = scoring_inputs(spark, folder)
    grid = explain.dependence_grid(inputs, ["number_inpatient"])["number_inpatient"]
    values = F.array(*[F.lit(int(v)) for v in grid])
    replaced = inputs.withColumn("number_inpatient", F.explode(values))
    return rounded(
        score.with_rule_score(replaced, noise=False).groupBy("number_inpatient")
        .agg(F.count("*").alias("n"), F.avg("risk_score").alias("average")))


def txt01_topics(spark, folder):
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", "role", score.topic(F.col("text")).alias("topic"))


def txt01_topic_counts(spark, folder):
    return table(spark, folder, "documents").groupBy(
        score.topic(F.col("text")).alias("topic")).agg(F.count("*").alias("n"))


def txt02_notices(spark, folder):
    return scored_records(spark, folder).select(
        "record_id",
        score.notice(F.col("patient_name"), F.col("risk_score"), F.col("status"),
                     "the discharge team").alias("message"))


def fe50_fasting_glucose(spark, folder):
    return scoring_inputs(spark, folder).groupBy(
        glucose_category(F.col("fasting_blood_sugar")).alias("glucose_category")
    ).agg(F.count("*").alias("n"))


QUERIES = {name: f for name, f in list(globals().items())
           if callable(f) and getattr(f, "__module__", "") == __name__
           and not name.startswith("_")
           and name not in ("scoring_inputs", "scored", "scored_records", "predictions")}
