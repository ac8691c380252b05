"""Common table expressions shared by the SQL equivalents."""

from __future__ import annotations

from wardline.sources.encounters import encounter_sql
from wardline.sources.layout import CODED, NULL_TOKENS, NUMERIC

TOKENS = ", ".join(f"'{t}'" for t in NULL_TOKENS)
# Text columns of the derived encounter table that can hold a null token.
GAPPED = ["race", "weight", "payer_code", "medical_specialty", "diag_1", "diag_2",
          "diag_3", "max_glu_serum", "A1Cresult"]

_ENC = f"enc AS MATERIALIZED ({encounter_sql()})"
_TOK = "tok AS (SELECT * REPLACE ({}) FROM enc)".format(", ".join(
    f"CASE WHEN {c} IN ({TOKENS}) THEN NULL ELSE {c} END AS {c}" for c in GAPPED))
_IMP = "imp AS (SELECT * REPLACE ({}) FROM tok)".format(", ".join(
    [f"coalesce({c}, (SELECT {c} FROM tok WHERE {c} IS NOT NULL GROUP BY {c} "
     f"ORDER BY count(*) DESC, {c} LIMIT 1)) AS {c}" for c in GAPPED]
    + [f"CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC]
    + [f"CAST({c} AS VARCHAR) AS {c}" for c in CODED]))
_UNI = "uni AS MATERIALIZED (SELECT DISTINCT * FROM imp)"
_CAPS = "caps AS (SELECT {} FROM uni)".format(", ".join(
    f"quantile_cont({c}, 0.01) AS {c}_lo, quantile_cont({c}, 0.99) AS {c}_hi" for c in NUMERIC))
_PREP = "prep AS MATERIALIZED (SELECT uni.* REPLACE ({}) FROM uni, caps)".format(", ".join(
    f"greatest({c}_lo, least({c}_hi, {c})) AS {c}" for c in NUMERIC))


def _code(c: str) -> str:
    head = f"split_part({c}, '.', 1)"
    return f"CASE WHEN regexp_full_match({head}, '[0-9]+') THEN CAST({head} AS DOUBLE) END"


def _chronic(lo: int, hi: int) -> str:
    tests = " OR ".join(f"coalesce(n{i} BETWEEN {lo} AND {hi}, false)" for i in (1, 2, 3))
    return f"CAST(({tests}) AS INT)"


_F1 = f"""f1 AS (SELECT *, {_code('diag_1')} AS n1, {_code('diag_2')} AS n2, {_code('diag_3')} AS n3,
  CASE WHEN time_in_hospital = 0 THEN 1 ELSE time_in_hospital END AS days,
  (CAST(regexp_extract(age, '([0-9]+)-([0-9]+)', 1) AS DOUBLE)
   + CAST(regexp_extract(age, '([0-9]+)-([0-9]+)', 2) AS DOUBLE)) / 2 AS age_midpoint,
  CAST(admission_type_id AS INT) AS ati, CAST(admission_source_id AS INT) AS asi,
  CAST(discharge_disposition_id AS INT) AS ddi
  FROM prep)"""
_F2 = f"""f2 AS (SELECT *,
  CAST(diag_1 IS NOT NULL AS INT) + CAST(diag_2 IS NOT NULL AS INT) + CAST(diag_3 IS NOT NULL AS INT) AS total_diagnoses_count,
  CAST(diag_1 IS NOT NULL AS INT) AS has_primary_diagnosis,
  CAST((SELECT count(DISTINCT d) FROM (VALUES (diag_1), (diag_2), (diag_3)) v(d)) AS INT) AS diagnosis_diversity,
  {_chronic(250, 250)} AS has_diabetes, {_chronic(390, 429)} AS has_heart_disease,
  {_chronic(460, 519)} AS has_respiratory_disease, {_chronic(580, 629)} AS has_kidney_disease,
  CAST(CASE WHEN num_medications <= -1 THEN NULL WHEN num_medications <= 5 THEN 1 WHEN num_medications <= 10 THEN 2 WHEN num_medications <= 999 THEN 3 END AS DOUBLE) AS medication_complexity_score,
  CAST(coalesce(lower(insulin) <> 'no', true) AS INT) AS insulin_usage,
  CAST(coalesce(lower(diabetesMed) = 'yes', false) AS INT) AS diabetic_med_flag,
  CAST(coalesce(lower(change) = 'ch', false) AS INT) AS medication_change_flag,
  CAST(CASE WHEN num_procedures <= -1 THEN NULL WHEN num_procedures <= 0 THEN 0 WHEN num_procedures <= 2 THEN 1 WHEN num_procedures <= 5 THEN 2 WHEN num_procedures <= 999 THEN 3 END AS DOUBLE) AS procedure_complexity_score,
  CAST(num_procedures > 0 AS INT) AS has_surgery,
  num_procedures / days AS procedure_to_stay_ratio,
  CAST(CASE WHEN time_in_hospital <= 0 THEN NULL WHEN time_in_hospital <= 3 THEN 0 WHEN time_in_hospital <= 7 THEN 1 WHEN time_in_hospital <= 14 THEN 2 WHEN time_in_hospital <= 999 THEN 3 END AS DOUBLE) AS hospital_stay_category,
  CAST(number_inpatient > 0 AS INT) AS readmission_history_flag,
  CAST(number_emergency > 0 AS INT) AS emergency_admission_flag,
  CASE ati WHEN 1 THEN 3 WHEN 2 THEN 2 ELSE 1 END AS admission_type_risk_score,
  CASE WHEN asi = 7 THEN 3 WHEN asi IN (1, 2) THEN 2 ELSE 1 END AS admission_source_risk,
  CASE WHEN number_inpatient = 0 THEN 0 ELSE 30 END AS days_since_last_admission,
  CAST(CASE WHEN age_midpoint <= -1 THEN NULL WHEN age_midpoint <= 40 THEN 0 WHEN age_midpoint <= 60 THEN 1 WHEN age_midpoint <= 75 THEN 2 WHEN age_midpoint <= 999 THEN 3 END AS DOUBLE) AS age_risk_group,
  CAST(coalesce(age_midpoint > 65, false) AS INT) AS elderly_flag,
  CAST(coalesce(age_midpoint > 75, false) AS INT) AS very_elderly_flag,
  CASE max_glu_serum WHEN 'Norm' THEN 1 WHEN '>200' THEN 2 WHEN '>300' THEN 3 ELSE 0 END AS glucose_level_category,
  CASE A1Cresult WHEN 'Norm' THEN 1 WHEN '>7' THEN 2 WHEN '>8' THEN 3 ELSE 0 END AS A1C_result_category,
  CAST(ddi = 1 AS INT) AS discharge_to_home_flag, CAST(ddi = 6 AS INT) AS discharge_with_services_flag,
  CAST(ddi = 7 AS INT) AS ama_discharge_flag,
  CASE WHEN ddi IN (3, 5, 6) THEN 2 WHEN ddi = 7 THEN 3 ELSE 1 END AS discharge_disposition_risk
  FROM f1)"""
_F3 = """f3 AS (SELECT *,
  has_diabetes + has_heart_disease + has_respiratory_disease + has_kidney_disease AS chronic_disease_count,
  has_diabetes + 2 * has_heart_disease + has_respiratory_disease + 2 * has_kidney_disease AS comorbidity_index
  FROM f2)"""
_FEAT = """feat AS MATERIALIZED (SELECT * EXCLUDE (n1, n2, n3, days, ati, asi, ddi),
  CAST(chronic_disease_count > 0 AS INT) AS chronic_diagnosis_flag,
  num_medications AS total_medications, num_procedures AS total_procedures,
  time_in_hospital * time_in_hospital AS length_of_stay_squared,
  ln(1 + time_in_hospital) AS length_of_stay_log,
  procedure_to_stay_ratio AS average_daily_procedures,
  hospital_stay_category AS time_in_hospital_category,
  coalesce(age_midpoint, 0) * coalesce(num_medications, 0) AS age_medication_interaction,
  coalesce(age_midpoint, 0) * chronic_disease_count AS age_comorbidity_interaction,
  num_lab_procedures AS lab_test_frequency,
  CAST(glucose_level_category > 1 AS INT) + CAST(A1C_result_category > 1 AS INT) AS abnormal_lab_count,
  coalesce(age_midpoint, 0) * coalesce(time_in_hospital, 0) AS age_length_stay,
  has_diabetes * diabetic_med_flag AS diabetes_medication_combo,
  num_procedures * num_medications AS procedures_medications,
  comorbidity_index * coalesce(age_risk_group, 0) AS comorbidity_age,
  emergency_admission_flag * elderly_flag AS emergency_elderly
  FROM f3)"""
_LAB = """lab AS MATERIALIZED (SELECT *, CASE WHEN readmitted = '<30' THEN 1 WHEN readmitted IN ('>30', 'NO') THEN 0 END AS label
  FROM feat WHERE readmitted IN ('<30', '>30', 'NO'))"""
_SPL = """spl AS MATERIALIZED (SELECT * EXCLUDE (pos, n_class),
  CASE WHEN pos <= (n_class * 70) // 100 THEN 'train' WHEN pos <= (n_class * 85) // 100 THEN 'val' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(encounter_id AS VARCHAR) || ':42')) AS pos,
               count(*) OVER (PARTITION BY label) AS n_class FROM lab) t)"""

_CHAIN = [("enc", _ENC), ("tok", _TOK), ("imp", _IMP), ("uni", _UNI), ("caps", _CAPS),
          ("prep", _PREP), ("f1", _F1), ("f2", _F2), ("f3", _F3), ("feat", _FEAT),
          ("lab", _LAB), ("spl", _SPL)]


def upto(name: str, query: str, *more: str) -> str:
    """``query`` over the chain of expressions up to ``name``, plus extra ones."""
    names = [n for n, _ in _CHAIN]
    ctes = [text for _, text in _CHAIN[: names.index(name) + 1]] + list(more)
    return "WITH " + ",\n".join(ctes) + "\n" + query


def union_all(parts) -> str:
    return "\nUNION ALL\n".join(parts)
