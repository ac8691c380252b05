"""Profiling, imputation, de-duplication and outliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.operators import clean, profile
from wardline.operators.features import ENGINEERED
from wardline.plans import stages
from wardline.plans.prepare import impute_and_type
from wardline.sources.encounters import table
from wardline.sources.layout import KEY, LABEL_CODED, NULL_TOKENS, NUMERIC

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
GAPPED = ["race", "weight", "payer_code", "medical_specialty", "diag_1", "diag_2",
          "diag_3", "max_glu_serum", "A1Cresult"]


def rounded(df, places=6):
    """Doubles at a fixed number of places, so engines agree on the last bit."""
    return df.select(*[
        F.round(c, places).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes
    ])


def lines(spark, folder):
    return table(spark, folder, "lineitem")


def known(spark, folder):
    return clean.null_tokens(stages.raw(spark, folder), NULL_TOKENS)


def prf01_table_profile(spark, folder):
    return profile.table_profile(table(spark, folder, "lineitem"))


def prf02_null_profile(spark, folder):
    return profile.null_profile(known(spark, folder))


def prf02_top_gaps(spark, folder):
    return profile.top_gaps(known(spark, folder), 20)


def prf03_duplicate_count(spark, folder):
    return profile.duplicate_count(
        table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber"))


def prf03_duplicate_rows(spark, folder):
    """Surplus copies among whole rows."""
    return profile.duplicate_count(table(spark, folder, "lineitem"))


def prf04_describe_all(spark, folder):
    """Every column of the raw encounters, whole numbers with their quartiles."""
    raw = known(spark, folder)
    return rounded(profile.describe(raw, raw.columns))


def prf04_describe_encounters(spark, folder):
    columns = ["race", "gender", "payer_code", "diag_1", "insulin", "readmitted"] + NUMERIC
    return rounded(profile.describe(known(spark, folder), columns))


def prf04_describe_lineitem(spark, folder):
    return rounded(profile.describe(lines(spark, folder), MEASURES + ["l_returnflag", "l_linestatus"]), 4)


def prf05_null_mask(spark, folder):
    return profile.null_mask(known(spark, folder), KEY, GAPPED, 500)


def prf06_columns_per_type(spark, folder):
    return profile.columns_per_type(stages.raw(spark, folder))


def prf07_null_change(spark, folder):
    return profile.null_change(known(spark, folder), stages.prepared(spark, folder))


def prf08_quality_score(spark, folder):
    return profile.quality_score(known(spark, folder), stages.prepared(spark, folder))


def prf09_null_check(spark, folder):
    from wardline.plans.model_table import scaled_split

    return profile.null_check(scaled_split(spark, folder)[0], "split")


def prf10_distinct_counts(spark, folder):
    return profile.distinct_counts(known(spark, folder), LABEL_CODED + ["diag_1", "weight"])


def prf11_feature_validation(spark, folder):
    made = stages.class_code(stages.featured(spark, folder))
    out = profile.feature_validation(made, ENGINEERED, "target_code")
    return rounded(out.drop("dtype", "feature_type"))


def prf12_feature_kinds(spark, folder):
    made = stages.featured(spark, folder)
    distinct = profile.distinct_counts(made, ENGINEERED)
    types = F.create_map(*[F.lit(x) for c, t in made.dtypes for x in (c, t)])
    return distinct.select(
        F.col("column").alias("feature"),
        profile.feature_kind(types[F.col("column")], F.col("n_distinct")).alias("feature_type"))


def prf13_model_kinds(spark, folder):
    from wardline.plans.model_table import model_columns, split_rows

    rows = split_rows(spark, folder)
    return profile.model_kinds(
        rows.where("split = 'train'"), model_columns(rows), LABEL_CODED)


def prf14_column_totals(spark, folder):
    return profile.column_totals(stages.prepared(spark, folder), stages.featured(spark, folder))


def cln01_median_impute(spark, folder):
    """Letter-coded diagnoses become gaps on coercion and take the median."""
    numbers = clean.to_number(
        stages.raw(spark, folder).select(KEY, "diag_1", "diag_2"), ["diag_1", "diag_2"])
    return clean.fill(numbers, clean.fit_medians(numbers, ["diag_1", "diag_2"]))


def cln02_mode_impute(spark, folder):
    raw = known(spark, folder).select(KEY, *GAPPED)
    return clean.fill(raw, clean.fit_modes(raw, GAPPED))


def cln03_imputation_log(spark, folder):
    raw = stages.raw(spark, folder)
    params = stages.cleaned(spark, folder)[1]
    return clean.imputation_log(raw, params.medians, params.modes)


def cln04_distinct_rows(spark, folder):
    return clean.distinct_rows(
        table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber"))


def cln04_distinct_whole_rows(spark, folder):
    return clean.distinct_rows(table(spark, folder, "lineitem"))


def cln04_duplicate_samples(spark, folder):
    pairs = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    return clean.duplicate_rows(pairs).orderBy("l_orderkey", "l_linenumber").limit(5)


def cln05_constant_fill(spark, folder):
    raw = known(spark, folder).select(KEY, "weight", "payer_code")
    return clean.fill(raw, {"weight": "0", "payer_code": "none"})


def cln_imputed_and_typed(spark, folder):
    return impute_and_type(stages.raw(spark, folder))[0]


def out01_outlier_report(spark, folder):
    unique = stages.once(
        spark, folder, "typed", lambda: impute_and_type(stages.raw(spark, folder))[0])
    return rounded(clean.outlier_report(unique, clean.fit_outliers(unique, NUMERIC)))


def out01_outlier_report_lineitem(spark, folder):
    rows = lines(spark, folder)
    return rounded(clean.outlier_report(rows, clean.fit_outliers(rows, MEASURES)), 4)


def out02_winsorised(spark, folder):
    return stages.prepared(spark, folder).select(KEY, *NUMERIC)


def out02_winsorised_lineitem(spark, folder):
    rows = lines(spark, folder).select("l_orderkey", "l_linenumber", *MEASURES)
    return rounded(clean.winsorise(rows, clean.fit_outliers(rows, MEASURES)), 4)


QUERIES = {f.__name__: f for f in (
    prf01_table_profile, prf02_null_profile, prf02_top_gaps, prf03_duplicate_count,
    prf04_describe_encounters, prf04_describe_lineitem, prf05_null_mask,
    prf06_columns_per_type, prf07_null_change, prf08_quality_score, prf09_null_check,
    prf10_distinct_counts, prf11_feature_validation, prf12_feature_kinds, prf13_model_kinds,
    prf14_column_totals, cln01_median_impute, cln02_mode_impute, cln03_imputation_log,
    cln04_distinct_rows, cln04_distinct_whole_rows, prf03_duplicate_rows, prf04_describe_all, cln04_duplicate_samples, cln05_constant_fill,
    cln_imputed_and_typed, out01_outlier_report, out01_outlier_report_lineitem,
    out02_winsorised, out02_winsorised_lineitem,
)}
