"""Shares, rates, cross-tabs, histograms, boxes, correlations, top-k, joins, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.operators import explore, profile
from wardline.operators.features import ENGINEERED
from wardline.operators.ordering import with_small_side
from wardline.plans import stages
from wardline.plans.catalogue.cleaning import MEASURES, known, lines, rounded
from wardline.sources.encounters import table
from wardline.sources.layout import CLASSES, DIAGNOSES, KEY, NUMERIC


def _returned():
    return explore.returned(F.col("readmitted"))


def agg01_class_shares(spark, folder):
    return explore.class_shares(stages.prepared(spark, folder), "readmitted")


def agg01_race_shares(spark, folder):
    return explore.class_shares(stages.prepared(spark, folder), "race")


def agg02_imbalance(spark, folder):
    return rounded(explore.imbalance(stages.prepared(spark, folder), "readmitted"))


def agg03_rate_by_gender(spark, folder):
    return rounded(explore.rate_by(stages.prepared(spark, folder), "gender", _returned()))


def agg03_rate_by_race(spark, folder):
    return rounded(
        explore.rate_by(stages.prepared(spark, folder), "race", _returned()).orderBy("rate", "race"))


def agg03_rate_by_comorbidity(spark, folder):
    early = F.col("readmitted") == "<30"
    return rounded(
        explore.rate_by(stages.featured(spark, folder), "comorbidity_index", early, "early_rate"))


def agg04_cross_tab(spark, folder):
    return explore.cross_tab(stages.prepared(spark, folder), "gender", "readmitted", CLASSES)


def agg04_age_by_class(spark, folder):
    return explore.cross_tab(stages.prepared(spark, folder), "age", "readmitted", CLASSES)


def agg05_stay_by_class(spark, folder):
    stats = explore.class_stats(
        stages.prepared(spark, folder), ["time_in_hospital"], "readmitted")
    return rounded(stats.select("readmitted", "mean", "median", "std"), 2)


def agg06_class_stats(spark, folder):
    return rounded(
        explore.class_stats(stages.prepared(spark, folder), NUMERIC, "readmitted"), 3)


# Limits so small that quantiles take the spread path at any scale.
SPREAD = {"limit": 2, "one_task_rows": 50}


def _with_gaps(spark, folder):
    return known(spark, folder).select("payer_code", *[F.col(c).cast("double").alias(c) for c in NUMERIC])


def agg06_class_stats_gaps(spark, folder):
    """Classes with an unknown one among them."""
    return rounded(explore.class_stats(_with_gaps(spark, folder), NUMERIC[:3], "payer_code"), 3)


def agg06_class_stats_gaps_spread(spark, folder):
    return rounded(explore.class_stats(_with_gaps(spark, folder), NUMERIC[:3], "payer_code", **SPREAD), 3)


def agg10_histogram_gaps(spark, folder):
    return rounded(explore.histogram(_with_gaps(spark, folder), ["time_in_hospital"], 14, "payer_code"))


def agg11_box_stats_gaps(spark, folder):
    return rounded(explore.box_stats(_with_gaps(spark, folder), "number_inpatient", "payer_code", **SPREAD))


def agg06_class_stats_lineitem(spark, folder):
    return rounded(
        explore.class_stats(lines(spark, folder), MEASURES, "l_returnflag"), 3)


def agg07_part_stats(spark, folder):
    from wardline.plans.model_table import SCALED, scaled_split

    return rounded(explore.part_stats(scaled_split(spark, folder)[0], SCALED, "split"), 4)


def agg09_histograms(spark, folder):
    return rounded(explore.histogram(stages.prepared(spark, folder), NUMERIC, 30))


def agg09_price_histogram(spark, folder):
    return rounded(explore.histogram(table(spark, folder, "orders"), ["o_totalprice"], 25), 4)


def agg10_histogram_by_class(spark, folder):
    return rounded(explore.histogram(
        stages.prepared(spark, folder), ["number_diagnoses", "time_in_hospital"], 14,
        "readmitted"))


def agg11_box_stats(spark, folder):
    return rounded(
        explore.box_stats(stages.prepared(spark, folder), "number_inpatient", "readmitted"))


def agg11_box_stats_price(spark, folder):
    return rounded(
        explore.box_stats(lines(spark, folder), "l_extendedprice", "l_returnflag"), 4)


def agg12_correlation_matrix(spark, folder):
    return rounded(explore.correlation_matrix(stages.prepared(spark, folder), NUMERIC))


def agg12_feature_correlation_matrix(spark, folder):
    return rounded(explore.correlation_matrix(stages.featured(spark, folder), ENGINEERED[:15]))


def agg13_target_correlation(spark, folder):
    coded = stages.class_code(stages.prepared(spark, folder))
    found = explore.target_correlations(coded, NUMERIC, "target_code")
    return rounded(found.orderBy(F.desc(F.abs("r")), "column"))


def agg14_value_shares(spark, folder):
    return rounded(explore.value_shares(
        stages.prepared(spark, folder), ["number_inpatient", "gender", "diag_1", "age"]))


def agg17_ordered_ages(spark, folder):
    bands = [f"[{i}-{i + 10})" for i in range(0, 120, 10)]
    return explore.ordered_counts(stages.prepared(spark, folder), "age", bands)


def srt01_sorted_rates(spark, folder):
    return rounded(
        explore.rate_by(stages.prepared(spark, folder), "payer_code", _returned())
        .orderBy(F.desc("rate"), "payer_code"))


def srt02_sorted_by_size(spark, folder):
    coded = stages.class_code(stages.featured(spark, folder))
    found = explore.target_correlations(coded, ENGINEERED, "target_code")
    return rounded(found.where("r is not null").orderBy(F.abs("r"), "column"))


def flt08_defined_correlations(spark, folder):
    coded = stages.class_code(stages.featured(spark, folder))
    found = explore.target_correlations(coded, ENGINEERED, "target_code")
    return found.where("r is not null").select("column")


def top01_top_diagnoses(spark, folder):
    return explore.top_values(stages.prepared(spark, folder), "diag_1", 15)


def top01_top_brands(spark, folder):
    return explore.top_values(table(spark, folder, "part"), "p_brand", 10)


def top02_strongest_features(spark, folder):
    coded = stages.class_code(stages.featured(spark, folder))
    return rounded(explore.strongest(
        explore.target_correlations(coded, ENGINEERED, "target_code"), 5), 5)


def top02_strongest_measures(spark, folder):
    coded = stages.class_code(stages.prepared(spark, folder))
    return rounded(explore.strongest(
        explore.target_correlations(coded, NUMERIC, "target_code"), 3), 5)


def smp01_seeded_sample(spark, folder):
    return profile.sample_rows(
        stages.prepared(spark, folder).select(KEY, "time_in_hospital", "num_medications"),
        KEY, 3000)


def jn01_code_lookup(spark, folder):
    """Country and region names of customers, by lookup in two small dimensions."""
    nation = table(spark, folder, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    region = table(spark, folder, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    named = with_small_side(table(spark, folder, "customer"), nation, ["c_nationkey"])
    return with_small_side(named, region, ["n_regionkey"]).select(
        "c_custkey", F.coalesce("n_name", F.lit("unknown")).alias("n_name"),
        F.coalesce("r_name", F.lit("unknown")).alias("r_name"))


def jn03_label_alignment(spark, folder):
    """Features and label kept in two tables, matched by key."""
    made = stages.labelled(spark, folder)
    features = made.select(KEY, "comorbidity_index", "age_midpoint")
    # As many rows as the other side: file sizes say little of them, so they are never broadcast.
    return features.join(made.select(KEY, "label").hint("merge"), KEY)


def jn04_rate_of_top_codes(spark, folder):
    rows = stages.prepared(spark, folder)
    top = explore.top_values(rows, "diag_1", 10).select("diag_1")
    kept = with_small_side(rows.select("diag_1", "readmitted"), top, ["diag_1"], "left_semi")
    return rounded(explore.rate_by(kept, "diag_1", _returned()))


def jn04_rate_of_top_codes_all_positions(spark, folder):
    rows = stages.prepared(spark, folder)
    parts = []
    for c in DIAGNOSES:
        top = explore.top_values(rows, c, 10).select(c)
        kept = with_small_side(rows.select(c, "readmitted"), top, [c], "left_semi")
        parts.append(explore.rate_by(kept, c, _returned()).withColumnRenamed(c, "code")
                     .withColumn("position", F.lit(c)))
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def jn06_before_after(spark, folder):
    """Distinct values per column before and after cleaning, side by side."""
    columns = ["race", "payer_code", "max_glu_serum", "diag_1"]
    old = profile.distinct_counts(known(spark, folder), columns)
    new = profile.distinct_counts(stages.prepared(spark, folder), columns + ["gender"])
    return old.withColumnRenamed("n_distinct", "before").join(
        new.withColumnRenamed("n_distinct", "after"), "column", "outer")


def set02_key_overlap(spark, folder):
    from wardline.operators.split import shared_keys
    from wardline.plans.model_table import split_rows

    return shared_keys(split_rows(spark, folder), KEY)


def set05_side_by_side(spark, folder):
    """Counts and mean stay per class in one table, aligned by class."""
    rows = stages.prepared(spark, folder)
    stay = explore.class_stats(rows, ["time_in_hospital"], "readmitted").select(
        "readmitted", "mean")
    return rounded(explore.class_shares(rows, "readmitted").join(stay, "readmitted", "outer"))


def set04_columns_left(spark, folder):
    """Row counts under the columns that remain after an exclusion list."""
    raw = stages.raw(spark, folder)
    left = sorted(set(raw.columns) - set(NUMERIC) - {"readmitted", KEY, "patient_nbr"})
    return raw.agg(F.count("*").alias("row_count")).select(
        F.explode(F.array(*map(F.lit, left))).alias("column"), "row_count")


QUERIES = {name: f for name, f in list(globals().items())
           if callable(f) and name[:3] in ("agg", "srt", "flt", "top", "smp", "jn0", "set")
           and getattr(f, "__module__", "") == __name__}
QUERIES |= {f.__name__: f for f in (
    agg06_class_stats_gaps, agg06_class_stats_gaps_spread, agg10_histogram_gaps, agg11_box_stats_gaps)}
