"""SQL for engineered columns, encodings, split and scaling."""

from __future__ import annotations

from oracles.blocks import upto, union_all
from oracles.cleaning import MODEL
from oracles.exploring import _SCALED, scaled_cols
from wardline.operators.features import ENGINEERED
from wardline.sources.layout import COLUMN_ORDER, LABEL_CODED, NUMERIC

_DOUBLES = set(NUMERIC) | {
    "total_medications", "medication_complexity_score", "total_procedures",
    "procedure_complexity_score", "procedure_to_stay_ratio", "hospital_stay_category",
    "length_of_stay_squared", "length_of_stay_log", "average_daily_procedures",
    "time_in_hospital_category", "age_midpoint", "age_risk_group",
    "age_medication_interaction", "age_comorbidity_interaction", "lab_test_frequency",
    "age_length_stay", "procedures_medications", "comorbidity_age",
}


def pick(columns):
    return ", ".join(f"round({c}, 6) AS {c}" if c in _DOUBLES else c for c in columns)


def coded(rel, c):
    """Position of the value among the distinct values of the column, in text order."""
    return f"CAST((SELECT count(DISTINCT coalesce(CAST(d.{c} AS VARCHAR), 'nan')) FROM {rel} d WHERE coalesce(CAST(d.{c} AS VARCHAR), 'nan') < coalesce(CAST(t.{c} AS VARCHAR), 'nan')) AS INT)"


def codes(rel, c):
    return f"k_{c} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INT) AS code FROM (SELECT DISTINCT coalesce(CAST({c} AS VARCHAR), 'nan') AS v FROM {rel}) t)"


def code_joins(columns):
    return " ".join(f"JOIN k_{c} ON k_{c}.v = coalesce(CAST(t.{c} AS VARCHAR), 'nan')" for c in columns)


def code_list(columns):
    return ", ".join(f"k_{c}.code AS {c}" if c in LABEL_CODED else (
        f"round(t.{c}, 6) AS {c}" if c in _DOUBLES else f"t.{c}") for c in columns)


GROUPS = {
    "fe01_diagnosis_counts": ENGINEERED[0:4], "fe05_chronic_diseases": ENGINEERED[4:10],
    "fe11_medications": ENGINEERED[10:15], "fe16_procedures": ENGINEERED[15:19],
    "fe20_hospital_stay": ENGINEERED[19:24], "fe25_admissions": ENGINEERED[24:29],
    "fe30_age": ENGINEERED[29:35], "fe36_labs": ENGINEERED[35:39],
    "fe40_discharge": ENGINEERED[39:43], "fe44_interactions": ENGINEERED[43:48],
}
_K = [codes("spl", c) for c in LABEL_CODED]
_texts = [c for c in COLUMN_ORDER if c not in NUMERIC + ["encounter_id", "patient_nbr", "readmitted"]]

SQL = {name: upto("feat", f"SELECT encounter_id, {pick(cols)} FROM feat") for name, cols in GROUPS.items()}
_ROUTED = {"label_encoding": ("coalesce(CAST({c} AS VARCHAR), 'nan')", "true", "<= 2"), "one_hot_encoding": ("CAST({c} AS VARCHAR)", "{c} IS NOT NULL", "> 2")}


def _routed(columns):
    return upto("prep", union_all(
        f"SELECT '{c}' AS \"column\", {columns.format(method=m)} FROM (SELECT {v.format(c=c)} AS v, count(*) AS n FROM prep WHERE {known.format(c=c)} GROUP BY 1) t WHERE (SELECT count(DISTINCT {c}) FROM prep) {size}"
        for c in _texts for m, (v, known, size) in _ROUTED.items()))


_PLACE = "CAST(row_number() OVER (ORDER BY v) - 1 AS INT) AS code"
_MODEL_CODES = "mdl AS MATERIALIZED (SELECT encounter_id, " + ", ".join(
    f"k_{c}.code AS {c}" if c in LABEL_CODED else f"t.{c}" for c in MODEL) + f", label, split FROM spl t {code_joins(LABEL_CODED)})"


def _scaled_model(places: int | None = 6) -> str:
    """The model columns, those that are scaled by the training rows' mean and deviation."""
    def one(c):
        value = f"(m.{c} - s.{c}_m) / s.{c}_s" if c in _SCALED else f"m.{c}"
        return f"round({value}, {places}) AS {c}" if places and (c in _SCALED or c in _DOUBLES) else f"{value} AS {c}"
    return "SELECT encounter_id, " + ", ".join(map(one, MODEL)) + ", label, split FROM mdl m, fit s"


_FIT = "fit AS (SELECT " + ", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in _SCALED) + " FROM mdl WHERE split = 'train')"
_GAPS = "gap AS MATERIALIZED (SELECT encounter_id, split, " + ", ".join(
    f"CASE WHEN (encounter_id + {i}) % 20 <> 0 THEN {c}::DOUBLE END AS {c}" for i, c in enumerate(MODEL)) + " FROM scm)"
_MEDIANS = "med AS (SELECT " + ", ".join(f"coalesce(quantile_cont({c}, 0.5), 0) AS {c}" for c in MODEL) + " FROM gap WHERE split = 'train')"
SQL |= {
    "snk03_model_snapshots": upto("spl", "SELECT *, f AS format FROM (" + _scaled_model() + ") t, (VALUES ('parquet'), ('csv')) v(f)", *_K, _MODEL_CODES, _FIT).replace("SELECT *, f AS format", "SELECT t.*, f AS format"),
    "cln06_all_model_inputs": upto("spl", "SELECT encounter_id, split, " + ", ".join(f"round(coalesce(gap.{c}, med.{c}), 6) AS {c}" for c in MODEL) + " FROM gap, med",
        *_K, _MODEL_CODES, _FIT, f"scm AS MATERIALIZED ({_scaled_model(None)})", _GAPS, _MEDIANS),
    "enc02_encoded_columns": _routed(_PLACE + ", n"),
    "enc07_fitted_map": _routed("'{method}' AS method, v AS value, " + _PLACE),
    "fe50_glucose_category": upto("enc", "SELECT encounter_id, CASE WHEN num_lab_procedures + 60 < 100 THEN 'NORMAL' WHEN num_lab_procedures + 60 < 126 THEN 'PREDIABETES' ELSE 'DIABETES RANGE' END AS glucose_category FROM enc"),
    "enc01_binary_codes": "SELECT l_orderkey, l_linenumber, l_partkey, CAST(dense_rank() OVER (ORDER BY l_linestatus) - 1 AS INT) AS l_linestatus FROM lineitem",
    "enc02_one_hot_wide": upto("prep", "SELECT encounter_id, " + ", ".join(
        [f"CAST(coalesce(insulin = '{v}', false) AS INT) AS insulin_{v}" for v in ("Down", "No", "Steady", "Up")]
        + [f"CAST(coalesce(payer_code = '{v}', false) AS INT) AS payer_code_{v}" for v in ("BC", "HM", "MC", "MD", "SP")]) + " FROM prep"),
    "enc02_one_hot_vectors": "SELECT CAST(row_number() OVER (ORDER BY p_brand) - 1 AS INT) AS code, n FROM (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand) t",
    "enc03_encoding_route": upto("prep", union_all(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct, CASE WHEN count(DISTINCT {c}) <= 2 THEN 'label_encoding' ELSE 'one_hot_encoding' END AS method FROM prep" for c in _texts)),
    "enc04_label_encoded": upto("prep", f"SELECT encounter_id, {code_list(LABEL_CODED)} FROM prep t {code_joins(LABEL_CODED)}", *[codes("prep", c) for c in LABEL_CODED]),
    "enc05_class_code": upto("prep", "SELECT encounter_id, CAST(dense_rank() OVER (ORDER BY readmitted) - 1 AS INT) AS label FROM prep"),
    "enc06_binary_target": upto("lab", "SELECT encounter_id, label FROM lab"),
    "enc07_encoding_map": upto("prep", union_all(
        f"SELECT '{c}' AS \"column\", v AS value, CAST(row_number() OVER (ORDER BY v) - 1 AS INT) AS code, 'label_encoding' AS method FROM (SELECT DISTINCT coalesce(CAST({c} AS VARCHAR), 'nan') AS v FROM prep) t" for c in LABEL_CODED + ["readmitted"])),
    "enc08_fixed_codes": upto("enc", """SELECT encounter_id, CAST(coalesce(CAST(regexp_extract(age, '([0-9]+)-', 1) AS INT) // 10, 7) AS INT) AS age_code,
 CASE gender WHEN 'Male' THEN 1 ELSE 0 END AS gender_code, CASE insulin WHEN 'Down' THEN 0 WHEN 'Steady' THEN 2 WHEN 'Up' THEN 3 ELSE 1 END AS insulin_code,
 CAST(coalesce(CAST(regexp_extract(age, '([0-9]+)-', 1) AS INT) + 5, 75) AS INT) AS age_middle FROM enc"""),
    "encoded_model_table": upto("spl", f"SELECT encounter_id, {code_list(MODEL)}, label, split FROM spl t {code_joins(LABEL_CODED)}", *_K),
    "prj03_feature_projection": upto("spl", f"SELECT encounter_id, {code_list(MODEL)} FROM spl t {code_joins(LABEL_CODED)} WHERE split = 'test'", *_K),
    "ml01_split": upto("spl", "SELECT encounter_id, label, split FROM spl"),
    "ml01_split_orders": """SELECT o_orderkey, o_orderstatus, CASE WHEN pos <= (n * 70) // 100 THEN 'train' WHEN pos <= (n * 85) // 100 THEN 'val' ELSE 'test' END AS split
FROM (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(CAST(o_orderkey AS VARCHAR) || ':42')) AS pos, count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders) t""",
    "ml02_leakage_checks": upto("spl", """SELECT 'Index overlap check' AS "check", CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT encounter_id FROM spl GROUP BY encounter_id HAVING count(DISTINCT split) > 1) t
UNION ALL SELECT 'Scaler fit on train only', 'PASS'
UNION ALL SELECT 'Stratification check', CASE WHEN max(r) - min(r) < 0.01 THEN 'PASS' ELSE 'FAIL' END FROM (SELECT avg(label) AS r FROM spl GROUP BY split) t"""),
    "ml18_positive_rate": upto("spl", "SELECT count(*) AS n, CAST(sum(label) AS BIGINT) AS n_positive, round(avg(label), 6) AS positive_rate FROM spl WHERE split = 'test'"),
    "snk03_split_snapshots": upto("spl", f"SELECT encounter_id, label, k_age.code AS age, comorbidity_index, split FROM spl t {code_joins(['age'])}", codes("spl", "age")),
    "cln06_model_input_impute": upto("spl", "SELECT encounter_id, coalesce(d, (SELECT quantile_cont(d, 0.5) FROM n WHERE split = 'train')) AS diag_2, split FROM n",
        "n AS (SELECT encounter_id, TRY_CAST(enc.diag_2 AS DOUBLE) AS d, split FROM enc JOIN spl USING (encounter_id))"),
    "ml18_toxic_rate": "SELECT count(*) AS n, round(avg(toxic), 6) AS positive_rate FROM labels",
    "agg08_split_summary": upto("spl", """SELECT split, count(*) AS n_samples, round(count(*)::DOUBLE / (SELECT count(*) FROM spl) * 100, 2) AS pct_total, count(*) FILTER (WHERE label = 1) AS n_readmitted,
 count(*) FILTER (WHERE label = 0) AS n_not_readmitted, round(avg(label) * 100, 2) AS readmission_rate FROM spl GROUP BY split"""),
    "agg19_rate_spread": upto("spl", "SELECT round(max(r) - min(r), 6) AS spread, CASE WHEN max(r) - min(r) < 0.01 THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT avg(label) AS r FROM spl GROUP BY split) t"),
    "scl01_scaler": upto("spl", union_all(f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std FROM spl WHERE split = 'train'" for c in _SCALED)),
    "scl02_scaled_rows": upto("spl", "SELECT encounter_id, split, " + ", ".join(f"round({c}, 6) AS {c}" for c in _SCALED) + " FROM sca", scaled_cols(_SCALED)),
    "scl03_scaling_report": upto("spl", union_all(
        f"SELECT '{c}' AS feature, " + ", ".join(f"round({e.format('spl.' + c)}, 4) AS {n}_before, round({e.format('sca.' + c)}, 4) + 0.0 AS {n}_after" for n, e in (
            ("mean", "avg({})"), ("std", "stddev_samp({})"), ("min", "min({})"), ("max", "max({})"))) + " FROM spl JOIN sca USING (encounter_id) WHERE spl.split = 'train'"
        for c in _SCALED), scaled_cols(_SCALED)),
}
