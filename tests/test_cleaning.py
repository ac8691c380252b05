"""Cleaning, features, encoding and scaling on hand-made rows."""

import math

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.functions.codes import band_midpoint, digest_mod, icd_number
from wardline.functions.stats import pearson, right_closed, with_rounded_tenth
from wardline.operators import clean, encode, explore, profile
from wardline.operators.features import (
    ENGINEERED, admission_features, diagnosis_features, lab_features, medication_features,
    stay_features,
)
from wardline.plans.prepare import binary_target
from wardline.sources import files
from wardline.session import work_path
from wardline.sources.layout import COLUMN_ORDER, NULL_TOKENS, encounter_schema


def one(df):
    return df.first().asDict()


def test_layout():
    assert len(COLUMN_ORDER) == 50 and len(set(COLUMN_ORDER)) == 50
    assert len(ENGINEERED) == 48
    assert encounter_schema()["readmitted"].dataType == T.StringType()


def test_null_tokens_and_csv(spark):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.IntegerType())])
    path = work_path(spark, "tokens")
    spark.createDataFrame(
        [("x", "1"), ("?", "2"), ("Unknown", "oops"), ("None", "4"), ("Unknown/Invalid", "?")],
        "a string, n string").coalesce(1).write.option("header", True).csv(path)
    got = {tuple(r) for r in files.read_csv(spark, path, schema).collect()}
    assert got == {("x", 1), (None, 2), (None, None), (None, 4), ("Unknown/Invalid", None)}


def test_modes_take_the_smallest_of_ties_and_skip_nulls(spark):
    df = spark.createDataFrame(
        [("b", "z"), ("a", None), ("b", None), ("a", None), (None, None)], "t string, u string")
    assert clean.columns_with_gaps(df) == ["t", "u"]
    assert clean.fit_modes(df, ["t", "u"]) == {"t": "a", "u": "z"}


def test_median_and_winsorising(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 101)] + [(None,)], "v double")
    assert clean.fit_medians(df, ["v"]) == {"v": 50.5}
    fit = clean.fit_outliers(df, ["v"])
    caps = fit["v"]
    assert caps["cap_lower"] == pytest.approx(1.99) and caps["q1"] == pytest.approx(25.75)
    got = [r.v for r in clean.winsorise(df, fit).collect()]
    assert min(v for v in got if v is not None) == pytest.approx(1.99)
    assert got.count(None) == 1


def test_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "x")], "a int, b string")
    assert clean.distinct_rows(df).count() == 2
    assert one(profile.duplicate_count(df)) == {"row_count": 4, "duplicate_rows": 2}
    assert [tuple(r) for r in clean.duplicate_rows(df).collect()] == [(1, None, 2)]


def test_right_closed_intervals(spark):
    df = spark.createDataFrame([(v,) for v in (-1, 0, 3, 4, 7, 14, 999, 1000, None)], "v int")
    got = [r[0] for r in df.select(right_closed(F.col("v"), [0, 3, 7, 14, 999], [0, 1, 2, 3])).collect()]
    assert got == [None, None, 0.0, 1.0, 1.0, 2.0, 3.0, None, None]


def test_codes_and_bands(spark):
    codes = ["250.83", "250", "V57", "E909", "428", None, "250d", ""]
    got = [r[0] for r in spark.createDataFrame([(c,) for c in codes], "c string").select(
        icd_number(F.col("c"))).collect()]
    assert got == [250.0, 250.0, None, None, 428.0, None, None, None]
    bands = ["[60-70)", "[0-10)", ">65", "71", "young", None]
    got = [r[0] for r in spark.createDataFrame([(c,) for c in bands], "c string").select(
        band_midpoint(F.col("c"))).collect()]
    assert got == [65.0, 5.0, 65.0, 71.0, None, None]


def test_digest_mod(spark):
    import hashlib

    names = ["John Doe", "Alex Morgan", "", "é"]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(
        digest_mod(F.col("n"), 200)).collect()]
    assert got == [int(hashlib.md5(n.encode()).hexdigest(), 16) % 200 for n in names]


def test_rounding_follows_the_binary_value(spark):
    values = [i / 100 for i in range(0, 9990, 5)] + [45.65, 45.35, 0.25, 0.75, 12.349999999999999]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = with_rounded_tenth(df, "r", F.col("v")).collect()
    assert [(r.v, r.r) for r in got] == [(v, round(v, 1)) for v in values]


def test_correlation_of_a_constant_is_undefined(spark):
    df = spark.createDataFrame(
        [(1.0, 5.0, 2.0, None), (2.0, 5.0, 4.0, 1.0), (4.0, 5.0, 9.0, 7.0), (5.0, 5.0, 1.0, 2.0)],
        "a double, k double, b double, gap double")
    assert df.agg(pearson(F.col("a"), F.col("k"))).first()[0] is None
    got = {(r.x, r.y): r.r for r in explore.correlation_matrix(df, df.columns).collect()}
    assert len(got) == 16
    assert got["a", "k"] is None and got["k", "k"] is None
    assert got["a", "a"] == pytest.approx(1.0)
    pdf = df.toPandas().corr()
    for x in ("a", "b", "gap"):
        for y in ("a", "b", "gap"):
            assert got[x, y] == pytest.approx(pdf.loc[x, y])


def test_flags_of_unknown_values(spark):
    row = one(medication_features(spark.createDataFrame(
        [(None, None, None, None)], "num_medications double, insulin string, diabetesMed string, change string")))
    assert (row["insulin_usage"], row["diabetic_med_flag"], row["medication_change_flag"]) == (1, 0, 0)
    assert row["medication_complexity_score"] is None
    row = one(admission_features(spark.createDataFrame(
        [(None, None, "x", None)],
        "number_inpatient double, number_emergency double, admission_type_id string, admission_source_id string")))
    assert row["readmission_history_flag"] == 0 and row["admission_type_risk_score"] == 1
    assert row["admission_source_risk"] == 1 and row["days_since_last_admission"] == 30


def test_diagnosis_and_lab_features(spark):
    row = one(diagnosis_features(spark.createDataFrame(
        [("250.1", "428", None)], "diag_1 string, diag_2 string, diag_3 string")))
    assert row["total_diagnoses_count"] == 2 and row["diagnosis_diversity"] == 2
    assert row["has_diabetes"] == 1 and row["has_heart_disease"] == 1
    assert row["comorbidity_index"] == 3 and row["chronic_disease_count"] == 2
    row = one(diagnosis_features(spark.createDataFrame(
        [("V57", "E909", None)], "diag_1 string, diag_2 string, diag_3 string")))
    assert row["chronic_diagnosis_flag"] == 0
    row = one(lab_features(spark.createDataFrame(
        [(4, ">300", ">7")], "num_lab_procedures int, max_glu_serum string, A1Cresult string")))
    assert row["abnormal_lab_count"] == 2 and row["glucose_level_category"] == 3


def test_zero_stay(spark):
    row = one(stay_features(spark.createDataFrame(
        [(0.0, 3.0)], "time_in_hospital double, num_procedures double")))
    assert row["average_daily_procedures"] == 3.0 and row["hospital_stay_category"] is None


@pytest.mark.parametrize("limit", [100, 2])
def test_label_codes_sort_as_text(spark, limit):
    df = spark.createDataFrame(
        [(1, "1", "b"), (2, "10", None), (3, "2", "a"), (4, "11", "z")], "k int, c string, d string")
    got = {r.k: (r.c, r.d) for r in encode.label_encode(df, ["c", "d"], limit=limit).collect()}
    assert got == {1: (0, 1), 2: (1, 2), 3: (3, 0), 4: (2, 3)}
    back = {r.column + r.value: r.code for r in encode.label_codes(df, ["c", "d"]).collect()}
    assert back["dnan"] == 2 and back["c2"] == 3


def test_one_hot(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, c string")
    wide = {r.k: (r.c_a, r.c_b) for r in encode.one_hot_wide(df, "c", ["a", "b"]).collect()}
    assert wide == {1: (1, 0), 2: (0, 1), 3: (0, 0)}
    vectors = encode.one_hot_vectors(df, ["c"], encode.one_hot_codes(df, ["c"])).collect()
    assert {r.k: list(r.c_vec.toArray()) for r in vectors} == {
        1: [1.0, 0.0], 2: [0.0, 1.0], 3: [0.0, 0.0]}


@pytest.mark.parametrize("limit", [100, 1])
def test_unseen_values_keep_their_rows(spark, limit):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, c string")
    codes = encode.label_codes(df, ["c"])
    other = spark.createDataFrame([(1, "b"), (2, "z"), (3, None)], "k int, c string")
    got = {r.k: r.c for r in encode.label_encode(other, ["c"], codes, limit).collect()}
    assert got == {1: 1, 2: None, 3: None}
    marked = {r.k: r.c for r in encode.label_encode(other, ["c"], codes, limit, unseen=-1).collect()}
    assert marked == {1: 1, 2: -1, 3: -1}
    vectors = encode.one_hot_vectors(other, ["c"], codes, limit).collect()
    assert {r.k: list(r.c_vec.toArray()) for r in vectors} == {1: [0.0, 1.0], 2: [0.0, 0.0], 3: [0.0, 0.0]}


def test_fitted_encoding_routes_every_text_column(spark):
    df = spark.createDataFrame(
        [(1, "x", "a"), (2, "y", "b"), (3, None, "c"), (4, "x", None), (5, "y", "nan")], "k int, two string, many string")
    fitted = encode.fit_encoding(df)
    assert fitted.methods == {"two": "label_encoding", "many": "one_hot_encoding"}
    rows = {r.k: (r.two, list(r.many_vec.toArray())) for r in encode.encode(df, fitted).collect()}
    assert rows == {1: (1, [1, 0, 0, 0]), 2: (2, [0, 1, 0, 0]), 3: (0, [0, 0, 1, 0]), 4: (1, [0, 0, 0, 0]), 5: (2, [0, 0, 0, 1])}
    wide = {r.k: (r.many_a, r.many_nan) for r in encode.encode(df, fitted, wide=True).collect()}
    assert wide == {1: (1, 0), 2: (0, 0), 3: (0, 0), 4: (0, 0), 5: (0, 1)}
    assert {(r.column, r.method) for r in encode.fitted_map(fitted).collect()} == set(fitted.methods.items())


def test_a_half_median_is_filled_in_as_it_is(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert sorted(r.x for r in clean.fill(df, clean.fit_medians(df, ["x"])).collect()) == [1.0, 1.5, 2.0]


def test_scaler_uses_population_deviation_and_keeps_constants(spark):
    df = spark.createDataFrame([(1.0, 4.0), (3.0, 4.0)], "a double, k double")
    fit = encode.fit_scaler(df, ["a", "k"])
    assert fit == {"a": (2.0, 1.0), "k": (4.0, 1.0)}
    assert [tuple(r) for r in encode.scale(df, fit).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_targets(spark):
    df = spark.createDataFrame([("<30",), (">30",), ("NO",), (None,), ("other",)], "readmitted string")
    assert [r.label for r in binary_target(df).collect()] == [1, 0, 0]
    rate = one(explore.rate_by(df.withColumn("g", F.lit("x")), "g", explore.returned(F.col("readmitted"))))
    assert rate["rate"] == 80.0


def test_histogram_closes_the_top_bin_and_keeps_empty_ones(spark):
    df = spark.createDataFrame([(float(v), 7.0) for v in (0, 1, 9, 10)], "v double, k double")
    got = {(r.column, r.bin): r.n for r in explore.histogram(df, ["v", "k"], 5).collect()}
    assert [got["v", i] for i in range(5)] == [2, 0, 0, 0, 2]
    assert sum(got["k", i] for i in range(5)) == 4 and got["k", 2] == 4


def test_description(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", None), (None, 4)], "t string, n int")
    got = {r.column: r for r in profile.describe(df, ["t", "n"]).collect()}
    assert (got["t"]["count"], got["t"].unique, got["t"].top, got["t"].freq) == (3, 2, "a", 2)
    assert got["n"]["count"] == 3 and got["n"].p50 == 2.0
    assert math.isclose(got["n"].std, 1.5275252316519468)


def test_quality_score(spark):
    before = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    after = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert one(profile.quality_score(before, after)) == {
        "rows_before": 3, "rows_after": 2, "rows_removed": 1, "nulls_before": 2,
        "nulls_after": 1, "quality_score": 75.0}


def test_tokens_include_the_reader_defaults():
    assert {"?", "Unknown", "", "None"} <= set(NULL_TOKENS)


def test_value_shares_skip_wide_columns(spark):
    df = spark.createDataFrame([Row(a=str(i % 3), b=str(i)) for i in range(30)])
    got = explore.value_shares(df, ["a", "b"]).collect()
    assert {r.column for r in got} == {"a"} and sum(r.share for r in got) == pytest.approx(1.0)
