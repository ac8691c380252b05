"""SQL for evaluation, scoring, the record feed and text routing."""

from __future__ import annotations

from oracles.blocks import upto, union_all
from oracles.cleaning import MODEL
from oracles.exploring import _SCALED, scaled_cols
from oracles.features import codes
from wardline.operators.score import (
    CARE_TEAM, FOLLOW_UPS, NO_TOPIC, RECOMMENDATIONS, TOPICS,
)
from wardline.sources.encounters import encounter_sql
from wardline.sources.layout import DRUG_COMBINATIONS, DRUGS

_head = "CASE WHEN regexp_full_match(split_part(diag_1, '.', 1), '[0-9]+') THEN CAST(split_part(diag_1, '.', 1) AS INT) END"
RAW = "raw AS MATERIALIZED (" + encounter_sql(extra=(
    "c_name AS patient_name", "o_orderdate AS recorded_at", "o_orderstatus AS origin")) + ")"
NOISE = """(CAST((CAST(('0x' || substr(md5({0}), 1, 16)) AS UBIGINT) % 200 * 16 + CAST(('0x' || substr(md5({0}), 17, 16)) AS UBIGINT) % 200) % 200 AS INT) - 100) / 100.0::DOUBLE"""
INP = f"""inp AS MATERIALIZED (SELECT encounter_id, patient_name, recorded_at, origin,
  '+1-555-' || lpad(CAST(patient_nbr % 10000 AS VARCHAR), 4, '0') AS phone,
  replace(replace(age, '[', ''), ')', '') AS age, gender,
  (['A+', 'A-', 'B+', 'B-', 'AB+', 'AB-', 'O+', 'O-', 'Unknown'])[encounter_id % 9 + 1] AS blood_group,
  num_lab_procedures + 60 AS fasting_blood_sugar, time_in_hospital, num_lab_procedures, num_medications,
  number_inpatient, number_diagnoses AS num_diagnoses, insulin, diabetesMed = 'Yes' AS on_medication,
  coalesce({_head} BETWEEN 390 AND 429 OR {_head} BETWEEN 580 AND 629, false) AS has_comorbidity,
  CASE WHEN readmitted = '<30' THEN 1 ELSE 0 END AS label FROM raw)"""


def points(noise: bool) -> str:
    extra = f" + {NOISE.format('patient_name')}" if noise else ""
    return f"""12.5::DOUBLE + (CASE age WHEN '0-10' THEN 0 WHEN '10-20' THEN 2 WHEN '20-30' THEN 4 WHEN '30-40' THEN 6 WHEN '40-50' THEN 10
  WHEN '50-60' THEN 15 WHEN '60-70' THEN 22 WHEN '70-80' THEN 28 WHEN '80-90' THEN 35 WHEN '90-100' THEN 40 ELSE 15 END) * 0.4::DOUBLE
  + least(number_inpatient * 9.5::DOUBLE, 45.0::DOUBLE) + time_in_hospital * 1.8::DOUBLE + num_lab_procedures * 0.12::DOUBLE
  + num_medications * 0.35::DOUBLE + greatest(0, num_diagnoses - 4) * 2.5::DOUBLE
  + CASE WHEN lower(insulin) IN ('up', 'down') THEN 7.5::DOUBLE WHEN lower(insulin) = 'steady' THEN 3.0::DOUBLE ELSE 0.0::DOUBLE END
  + CASE WHEN has_comorbidity THEN 14.5::DOUBLE ELSE 0.0::DOUBLE END
  - CASE WHEN on_medication THEN 0.0::DOUBLE ELSE 5.0::DOUBLE END{extra}"""


def tenth(name: str, noise: bool) -> str:
    return tenth_of(name, points(noise), "inp")


def tenth_of(name: str, value: str, source: str) -> str:
    """Score rounded by exact value: the nearest of the two neighbouring tenths."""
    return f"""{name} AS MATERIALIZED (SELECT * EXCLUDE (x, s, e), CASE
  WHEN s - floor(s) < 0.5 OR (s - floor(s) = 0.5 AND (e < 0 OR (e = 0 AND floor(s) % 2 = 0))) THEN floor(s) ELSE floor(s) + 1 END / 10.0::DOUBLE AS risk_score
FROM (SELECT *, (x * 8 - (s - (s - x * 8))) + (x * 2 - (s - x * 8)) AS e FROM (SELECT *, x * 8 + x * 2 AS s FROM
 (SELECT *, greatest(5.2::DOUBLE, least(98.7::DOUBLE, {value})) AS x FROM {source}) a) b) c)"""


SCO = tenth("sco", True)
TIER = "CASE WHEN risk_score >= 40 THEN 'HIGH' WHEN risk_score >= 25 THEN 'MODERATE' ELSE 'LOW' END"


def doctor(status: str, field: int = 1) -> str:
    return "CASE {} {} ELSE '{}' END".format(
        status, " ".join(f"WHEN '{t[0]}' THEN '{t[field]}'" for t in CARE_TEAM), CARE_TEAM[2][field])


REC = f"""rec AS MATERIALIZED (SELECT encounter_id AS record_id, recorded_at AS timestamp, patient_name, phone, age, risk_score, time_in_hospital AS los,
  {TIER} AS status, {doctor(TIER.join('()'))} AS allocated_doctor, blood_group, fasting_blood_sugar,
  CASE WHEN fasting_blood_sugar < 100 THEN 'NORMAL' WHEN fasting_blood_sugar < 126 THEN 'PREDIABETES' ELSE 'DIABETES RANGE' END AS glucose_category, origin, label FROM sco)"""
PRE = """pre AS MATERIALIZED (SELECT *, CASE WHEN y_prob > 0.5 THEN 1 ELSE 0 END AS y_pred FROM (
  SELECT 'Rule Score' AS model, encounter_id, label, risk_score / 100 AS y_prob FROM sco
  UNION ALL SELECT 'Prior Admissions', encounter_id, label, least(number_inpatient, 8) / 8.0::DOUBLE FROM sco
  UNION ALL SELECT 'Length Of Stay', encounter_id, label, time_in_hospital / 14.0::DOUBLE FROM sco) t)"""
STEPS = """steps AS MATERIALIZED (SELECT model, y_prob, pos, neg, CAST(sum(pos) OVER w AS BIGINT) AS cum_pos, CAST(sum(neg) OVER w AS BIGINT) AS cum_neg
  FROM (SELECT model, y_prob, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM pre GROUP BY model, y_prob) t
  WINDOW w AS (PARTITION BY model ORDER BY y_prob DESC ROWS UNBOUNDED PRECEDING))"""
CONF = """conf AS (SELECT model, count(*) FILTER (WHERE label = 0 AND y_pred = 0) AS tn, count(*) FILTER (WHERE label = 0 AND y_pred = 1) AS fp,
  count(*) FILTER (WHERE label = 1 AND y_pred = 0) AS fn, count(*) FILTER (WHERE label = 1 AND y_pred = 1) AS tp FROM pre GROUP BY model)"""
RATES = """rates AS (SELECT model, (tp + tn)::DOUBLE / (tp + tn + fp + fn) AS accuracy, coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS "precision",
  coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * tp::DOUBLE / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM conf)"""
# Area by the rank-sum of the positives, an independent form of the same number.
AUC = """auc AS (SELECT model, (sum(r) FILTER (WHERE label = 1) - n1 * (n1 + 1) / 2.0) / (n1::DOUBLE * n0) AS roc_auc FROM (
  SELECT model, label, rank() OVER (PARTITION BY model ORDER BY y_prob) + (count(*) OVER (PARTITION BY model, y_prob) - 1) / 2.0::DOUBLE AS r,
  count(*) FILTER (WHERE label = 1) OVER (PARTITION BY model) AS n1, count(*) FILTER (WHERE label = 0) OVER (PARTITION BY model) AS n0 FROM pre) t GROUP BY model, n1, n0)"""
PROB = """prob AS (SELECT p.model, avg((label - y_prob) * (label - y_prob)) AS brier, 1 - sum((label - y_prob) * (label - y_prob)) / sum((label - m) * (label - m)) AS r2
  FROM pre p JOIN (SELECT model, avg(label) AS m FROM pre GROUP BY model) q ON p.model = q.model GROUP BY p.model)"""
CMP = """cmp AS MATERIALIZED (SELECT model, round(accuracy, 4) AS accuracy, round("precision", 4) AS "precision", round(recall, 4) AS recall, round(f1, 4) AS f1,
  round(roc_auc, 4) AS roc_auc, round(brier, 4) AS brier, round(r2, 4) AS r2 FROM rates JOIN auc USING (model) JOIN prob USING (model))"""
RNK = """rnk AS (SELECT *, rank_auc + rank_acc AS combined_rank FROM (SELECT *, rank() OVER (ORDER BY roc_auc DESC) + (count(*) OVER (PARTITION BY roc_auc) - 1) / 2.0::DOUBLE AS rank_auc,
  rank() OVER (ORDER BY accuracy DESC) + (count(*) OVER (PARTITION BY accuracy) - 1) / 2.0::DOUBLE AS rank_acc FROM cmp) t)"""
_S = (RAW, INP, SCO)
_P = _S + (PRE,)
_C = _P + (CONF, RATES, AUC, PROB, CMP)
_R = _S + (REC,)


def plain(query, *ctes):
    return "WITH " + ",\n".join(ctes) + "\n" + query


def topic(c):
    tests = []
    for name, words, also in TOPICS:
        test = "(" + " OR ".join(f"contains(lower({c}), '{w}')" for w in words) + ")"
        tests.append(f"WHEN {test}" + "".join(f" AND contains(lower({c}), '{w}')" for w in also) + f" THEN '{name}'")
    return f"CASE {' '.join(tests)} ELSE '{NO_TOPIC}' END"


def lookup(c, texts):
    return f"CASE {c} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in texts) + " END"


def model_inputs():
    age = "CAST(split_part(age, '-', 1) AS INT)"
    known = f"CASE WHEN age IN ({', '.join(repr(f'{10 * i}-{10 * i + 10}') for i in range(10))}) THEN {age} END"
    mid = f"coalesce({known} + 5, 75)"
    stay = "CASE WHEN time_in_hospital <= 3 THEN 0 WHEN time_in_hospital <= 7 THEN 1 WHEN time_in_hospital <= 14 THEN 2 ELSE 3 END"
    group = f"CASE WHEN {mid} <= 40 THEN 0 WHEN {mid} <= 60 THEN 1 WHEN {mid} <= 75 THEN 2 ELSE 3 END"
    ill, med = "CAST(has_comorbidity AS INT)", "CAST(on_medication AS INT)"
    rule = {
        "race": "2", "admission_type_id": "1", "discharge_disposition_id": "1", "admission_source_id": "7",
        "num_procedures": "1", "has_primary_diagnosis": "1", "diagnosis_diversity": "3", "total_procedures": "1",
        "procedure_complexity_score": "1", "has_surgery": "1", "admission_type_risk_score": "3",
        "admission_source_risk": "3", "discharge_to_home_flag": "1", "discharge_disposition_risk": "1",
        "gender": "CASE gender WHEN 'Male' THEN 1 ELSE 0 END", "age": f"coalesce({known} // 10, 7)",
        "number_diagnoses": "num_diagnoses", "total_diagnoses_count": "num_diagnoses",
        "insulin": "CASE insulin WHEN 'Down' THEN 0 WHEN 'Steady' THEN 2 WHEN 'Up' THEN 3 ELSE 1 END",
        "change": "CASE WHEN insulin IN ('No', 'Steady') THEN 1 ELSE 0 END", "diabetesMed": med,
        "diabetic_med_flag": med, "chronic_disease_count": f"4 * {ill}", "comorbidity_index": f"6 * {ill}",
        "total_medications": "num_medications",
        "medication_complexity_score": "CASE WHEN num_medications <= 5 THEN 1 WHEN num_medications <= 10 THEN 2 ELSE 3 END",
        "insulin_usage": "CASE WHEN insulin = 'No' THEN 0 ELSE 1 END",
        "medication_change_flag": "CASE WHEN insulin IN ('Up', 'Down') THEN 1 ELSE 0 END",
        "procedure_to_stay_ratio": "1.0::DOUBLE / greatest(1, time_in_hospital)",
        "average_daily_procedures": "1.0::DOUBLE / greatest(1, time_in_hospital)",
        "hospital_stay_category": stay, "time_in_hospital_category": stay,
        "length_of_stay_squared": "time_in_hospital * time_in_hospital",
        "length_of_stay_log": "ln(1 + time_in_hospital)",
        "readmission_history_flag": "CASE WHEN number_inpatient > 0 THEN 1 ELSE 0 END",
        "days_since_last_admission": "CASE WHEN number_inpatient > 0 THEN 30 ELSE 0 END",
        "age_midpoint": mid, "age_risk_group": group, "elderly_flag": f"CAST({mid} > 65 AS INT)",
        "very_elderly_flag": f"CAST({mid} > 75 AS INT)", "age_medication_interaction": f"{mid} * num_medications",
        "age_comorbidity_interaction": f"{mid} * 4 * {ill}", "lab_test_frequency": "num_lab_procedures",
        "age_length_stay": f"{mid} * time_in_hospital", "diabetes_medication_combo": f"{ill} * {med}",
        "procedures_medications": "num_medications", "comorbidity_age": f"6 * {ill} * ({group})",
    }
    rule |= {c: ill for c in ("chronic_diagnosis_flag", "has_diabetes", "has_heart_disease", "has_respiratory_disease", "has_kidney_disease")}
    rule |= {c: c for c in ("time_in_hospital", "num_lab_procedures", "num_medications", "number_inpatient")}
    rule |= {d: "1" for d in DRUGS if d != "insulin"} | {d: "0" for d in DRUG_COMBINATIONS}
    return ", ".join(f"round(CAST({rule.get(c, '0')} AS DOUBLE), 6) AS {c}" for c in MODEL)


_TEST = "test AS MATERIALIZED (SELECT encounter_id, comorbidity_index, length_of_stay_log FROM sca WHERE split = 'test')"

SQL = {
    "ml06_confusion": plain("SELECT * FROM conf", *_P, CONF),
    "ml07_rates": plain("SELECT model, round(accuracy, 6) AS accuracy, round(\"precision\", 6) AS \"precision\", round(recall, 6) AS recall, round(f1, 6) AS f1 FROM rates", *_P, CONF, RATES),
    "ml08_roc_auc": plain("SELECT model, round(roc_auc, 6) AS roc_auc FROM auc", *_P, AUC),
    "ml09_ml10_probability_scores": plain("SELECT model, round(brier, 6) AS brier, round(r2, 6) AS r2 FROM prob", *_P, PROB),
    "ml11_roc_curve": plain("SELECT model, round(y_prob, 6) AS threshold, round(cum_neg::DOUBLE / sum(neg) OVER (PARTITION BY model), 6) AS fpr, round(cum_pos::DOUBLE / sum(pos) OVER (PARTITION BY model), 6) AS tpr FROM steps", *_P, STEPS),
    "win03_score_steps": plain("SELECT model, round(y_prob, 6) AS y_prob, pos, neg, cum_pos, cum_neg FROM steps", *_P, STEPS),
    "ml12_model_comparison": plain("SELECT * FROM cmp ORDER BY roc_auc DESC, model", *_C),
    "ml13_best_models": plain("SELECT (SELECT model FROM cmp ORDER BY roc_auc DESC, model LIMIT 1) AS best_auc, (SELECT model FROM cmp ORDER BY accuracy DESC, roc_auc DESC, model LIMIT 1) AS best_accuracy, (SELECT model FROM rnk ORDER BY combined_rank, roc_auc DESC, model LIMIT 1) AS best_overall", *_C, RNK),
    "win01_average_ranks": plain("SELECT model, rank_auc, rank_acc, combined_rank FROM rnk", *_C, RNK),
    "win02_rank_sum_winner": plain("SELECT model, combined_rank FROM rnk ORDER BY combined_rank, roc_auc DESC, model LIMIT 1", *_C, RNK),
    "top03_arg_max": plain("SELECT model, brier FROM cmp ORDER BY brier DESC, model LIMIT 1", *_C),
    "ml17_f1_and_average_precision": plain("""SELECT model, round(fp1, 6) AS f1_positive, round((fp1 * (tp + fn) + coalesce(2 * tn::DOUBLE / nullif(2 * tn + fp + fn, 0), 0) * (tn + fp)) / (tp + fp + tn + fn), 6) AS f1_weighted,
  round(ap, 6) AS average_precision FROM (SELECT *, coalesce(2 * tp::DOUBLE / nullif(2 * tp + fp + fn, 0), 0) AS fp1 FROM conf) c
  JOIN (SELECT model, sum(pos * cum_pos::DOUBLE / (cum_pos + cum_neg)) / sum(pos) AS ap FROM steps GROUP BY model) s USING (model)""", *_P, CONF, STEPS),
    "win04_middle_row": upto("prep", "SELECT encounter_id, time_in_hospital, readmitted FROM (SELECT *, row_number() OVER (ORDER BY encounter_id) AS rn, count(*) OVER () AS n FROM prep) t WHERE rn = n // 2 + 1"),
    "win05_latest_per_patient": plain("SELECT patient_name, record_id, timestamp, risk_score, status FROM (SELECT *, row_number() OVER (PARTITION BY patient_name ORDER BY timestamp DESC, record_id) AS rn FROM rec) t WHERE rn = 1", *_R),
    "srt03_extreme_rows": upto("feat", """(SELECT encounter_id, comorbidity_index, round(length_of_stay_log, 6) AS length_of_stay_log, 'highest' AS which FROM feat ORDER BY comorbidity_index DESC, feat.length_of_stay_log DESC, encounter_id LIMIT 1)
UNION ALL (SELECT encounter_id, comorbidity_index, round(length_of_stay_log, 6), 'lowest' FROM feat ORDER BY comorbidity_index, feat.length_of_stay_log, encounter_id LIMIT 1)"""),
    "scr01_rule_score": plain("SELECT encounter_id, risk_score FROM sco", *_S),
    "scr01_rule_score_without_noise": plain("SELECT encounter_id, risk_score FROM bare", RAW, INP, tenth("bare", False)),
    "scr02_name_noise": f"SELECT c_custkey, {NOISE.format('c_name')} AS noise FROM customer",
    "scr05_risk_tiers": plain(f"""SELECT encounter_id, {TIER} AS assessment, CASE WHEN risk_score < 25 THEN 'LOW' WHEN risk_score < 50 THEN 'MODERATE' ELSE 'HIGH' END AS sample,
  CASE WHEN risk_score > 35 THEN 'CRITICAL / HIGH RISK' WHEN risk_score > 25 THEN 'MODERATE RISK' ELSE 'LOW RISK' END AS demonstration,
  CASE WHEN risk_score / 100 > 0.5 THEN 'HIGH' WHEN risk_score / 100 > 0.3::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END AS probability,
  CASE WHEN risk_score / 100 > 0.5 THEN 'FOLLOW UP' ELSE 'ROUTINE' END AS follow_up FROM sco""", *_S),
    "scr06_recommendations": plain(f"SELECT encounter_id, category, status, {lookup('category', RECOMMENDATIONS)} AS recommendation, {lookup('status', FOLLOW_UPS)} AS follow_up FROM (SELECT encounter_id, CASE WHEN risk_score > 35 THEN 'CRITICAL / HIGH RISK' WHEN risk_score > 25 THEN 'MODERATE RISK' ELSE 'LOW RISK' END AS category, {TIER} AS status FROM sco) t", *_S),
    "scr07_care_team": f"SELECT o_orderkey, status, {doctor('upper(status)')} AS allocated_doctor, {doctor('upper(status)', 3)} AS contact FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'high' WHEN 'O' THEN 'MODERATE' ELSE 'other' END AS status FROM orders) t",
    "jn02_care_team_default": f"SELECT event_type AS status, {doctor('upper(event_type)')} AS allocated_doctor, count(*) AS n FROM events GROUP BY event_type",
    "scr08_records": plain("SELECT * EXCLUDE (origin, label) REPLACE (strftime(timestamp, '%Y-%m-%d') AS timestamp) FROM rec", *_R),
    "snk04_appended_records": plain("SELECT record_id, patient_name, risk_score, status FROM rec", *_R),
    "snk04_upserted_records": plain("SELECT record_id, patient_name, risk_score, status, CAST(strftime(timestamp, '%Y%m') AS INT) AS period FROM rec", *_R),
    "src05_newest_of_the_store": plain("SELECT record_id, patient_name, risk_score, status FROM rec ORDER BY timestamp DESC, record_id LIMIT 100", *_R),
    "scr09_merged_feed_of_the_store": plain("""SELECT record_id, patient_name, risk_score, status, blood_group FROM near UNION ALL
SELECT record_id, patient_name, risk_score, status, NULL FROM rec WHERE origin IN ('O', 'P') AND record_id NOT IN (SELECT record_id FROM near)""", *_R,
        "near AS MATERIALIZED (SELECT * FROM rec ORDER BY timestamp DESC, record_id LIMIT 100)"),
    "src05_newest_records": plain("SELECT record_id, patient_name, risk_score, status FROM rec ORDER BY timestamp DESC, record_id LIMIT 100", *_R),
    "top04_newest_few": plain("SELECT record_id, risk_score FROM rec ORDER BY timestamp DESC, record_id LIMIT 8", *_R),
    "src06_sample_feed": upto("spl", f"""SELECT patient_name, phone, age, risk_score, los, status, {doctor('status')} AS allocated_doctor FROM (
  SELECT 'Sample Patient #' || CAST(pos + 101 AS VARCHAR) AS patient_name, '+1-555-0' || CAST(pos + 100 AS VARCHAR) AS phone, CAST(code * 10 AS VARCHAR) || '-' || CAST(code * 10 + 10 AS VARCHAR) AS age,
   r AS risk_score, CAST(time_in_hospital AS INT) AS los, CASE WHEN r < 25 THEN 'LOW' WHEN r < 50 THEN 'MODERATE' ELSE 'HIGH' END AS status FROM (
   SELECT t.time_in_hospital, k_age.code, row_number() OVER (ORDER BY encounter_id) - 1 AS pos, least(98.5::DOUBLE, 15.0 + num_lab_procedures / 2 + number_inpatient * 10) AS r FROM spl t JOIN k_age ON k_age.v = t.age WHERE split = 'test' ORDER BY encounter_id LIMIT 120) a) b""", codes("spl", "age")),
    "scr09_merged_feed": plain("""SELECT record_id, patient_name, risk_score, status, blood_group FROM near UNION ALL
SELECT record_id, patient_name, risk_score, status, NULL FROM rec WHERE origin IN ('O', 'P') AND record_id NOT IN (SELECT record_id FROM near)""", *_R,
        "near AS MATERIALIZED (SELECT * FROM rec WHERE origin IN ('F', 'O') ORDER BY timestamp DESC, record_id LIMIT 100)"),
    "jn05_unseen_records": plain("SELECT record_id, patient_name FROM rec WHERE origin IN ('O', 'P') AND record_id NOT IN (SELECT record_id FROM rec WHERE origin IN ('F', 'O'))", *_R),
    "set01_union": plain("SELECT record_id, risk_score, blood_group FROM rec WHERE origin IN ('F', 'O') UNION ALL SELECT record_id, risk_score, NULL FROM rec WHERE origin IN ('O', 'P')", *_R),
    "scr10_feed_display": plain("SELECT strftime(timestamp, '%Y-%m-%d %H:%M') AS \"date\", patient_name AS patient, age AS age_group, printf('%.1f%%', risk_score) AS risk, status, allocated_doctor AS doctor FROM rec", *_R),
    "flt05_status_filter": plain("SELECT record_id, status FROM rec WHERE status = 'HIGH'", *_R),
    "flt06_patient_history": plain("SELECT record_id, patient_name, risk_score FROM rec WHERE lower(trim(patient_name)) = 'customer#000000077'", *_R),
    "snk05_history_export": plain("SELECT strftime(timestamp, '%Y-%m-%d %H:%M') AS \"date\", patient_name AS patient, age AS age_group, printf('%.1f%%', risk_score) AS risk, status, allocated_doctor AS doctor FROM rec WHERE status = 'MODERATE'", *_R),
    "agg15_feed_totals": plain("SELECT count(*) AS total_analyzed, round(avg(risk_score), 1) AS avg_risk, count(*) FILTER (WHERE status = 'HIGH') AS high_risk_alerts FROM rec", *_R),
    "agg16_status_counts": plain("SELECT s AS status, (SELECT count(*) FROM rec WHERE status = s) AS n FROM (VALUES ('LOW'), ('MODERATE'), ('HIGH')) v(s)", *_R),
    "agg16_other_statuses": "SELECT upper(event_type) AS status, count(*) AS n FROM events GROUP BY 1 UNION ALL SELECT s, 0 FROM (VALUES ('LOW'), ('MODERATE'), ('HIGH')) v(s)",
    "scr11_example_picks": upto("spl", """SELECT encounter_id, comorbidity_index, round(l, 6) AS length_of_stay_log, example, round(exp(l), 6) AS days FROM (
 (SELECT encounter_id, comorbidity_index, length_of_stay_log AS l, 'complex' AS example FROM test ORDER BY comorbidity_index DESC, l DESC, encounter_id LIMIT 1) UNION ALL
 (SELECT encounter_id, comorbidity_index, length_of_stay_log, 'low complexity' FROM test ORDER BY comorbidity_index, length_of_stay_log, encounter_id LIMIT 1) UNION ALL
 (SELECT encounter_id, comorbidity_index, length_of_stay_log, 'standard' FROM (SELECT *, row_number() OVER (ORDER BY encounter_id) AS rn, count(*) OVER () AS n FROM test) u WHERE rn = n // 2 + 1)) t""", scaled_cols(_SCALED), _TEST),
    "scr12_follow_up_list": plain("SELECT record_id AS encounter_id, label, round(risk_score / 100, 6) AS probability FROM rec WHERE risk_score / 100 > 0.5", *_R),
    "scr12_cohort_trend": plain("SELECT strftime(timestamp, '%Y-%m') AS month, count(*) AS n, round(avg(label) * 100, 6) AS readmission_rate FROM rec WHERE risk_score / 100 > 0.5 GROUP BY 1", *_R),
    "fe49_scoring_columns": plain(f"SELECT encounter_id, patient_name, {model_inputs()} FROM inp", RAW, INP),
    "prj05_default_columns": plain("SELECT encounter_id, 2.0::DOUBLE AS race, 7.0::DOUBLE AS admission_source_id, 1.0::DOUBLE AS num_procedures, 1.0::DOUBLE AS discharge_disposition_risk, 0.0::DOUBLE AS emergency_elderly FROM inp", RAW, INP),
    "jn07_rows_by_grid": plain("SELECT number_inpatient, count(*) AS n, round(avg(risk_score), 6) AS average FROM bare GROUP BY number_inpatient", RAW,
        INP.replace("inp AS MATERIALIZED", "base AS MATERIALIZED"),
        "inp AS MATERIALIZED (SELECT base.* REPLACE (g.v AS number_inpatient) FROM base, (SELECT DISTINCT number_inpatient AS v FROM base) g)", tenth("bare", False)),
    "txt01_topics": f"SELECT conv_id, turn, role, {topic('text')} AS topic FROM conversations",
    "txt01_topic_counts": f"SELECT {topic('text')} AS topic, count(*) AS n FROM documents GROUP BY 1",
    "txt02_notices": plain("SELECT record_id, 'Hi ' || patient_name || ', this is the discharge team. Your clinical analysis is complete. Risk Level: ' || status || ' (' || printf('%.1f%%', risk_score) || '). Our team will reach out shortly.' AS message FROM rec", *_R),
    "fe50_fasting_glucose": plain("SELECT CASE WHEN fasting_blood_sugar < 100 THEN 'NORMAL' WHEN fasting_blood_sugar < 126 THEN 'PREDIABETES' ELSE 'DIABETES RANGE' END AS glucose_category, count(*) AS n FROM inp GROUP BY 1", RAW, INP),
}
