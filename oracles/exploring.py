"""SQL for exploratory aggregates, top-k, joins and set operations."""

from __future__ import annotations

from oracles.blocks import upto, union_all
from oracles.cleaning import MEASURES, _T
from wardline.operators.features import ENGINEERED
from wardline.sources.layout import COLUMN_ORDER, NUMERIC

_SCALED = [
    "time_in_hospital", "num_lab_procedures", "num_medications", "total_medications",
    "procedure_to_stay_ratio", "length_of_stay_squared", "length_of_stay_log",
    "average_daily_procedures", "age_medication_interaction",
    "age_comorbidity_interaction", "lab_test_frequency", "age_length_stay",
    "procedures_medications", "comorbidity_age",
]


def shares(rel, c):
    return f"SELECT {c}, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM {rel}) * 100, 2) AS pct FROM {rel} GROUP BY {c}"


def rate(rel, c, hit="coalesce(readmitted <> 'NO', true)", name="rate", where="true"):
    return f"SELECT {c}, count(*) AS n, round(avg(CASE WHEN {hit} THEN 100.0 ELSE 0.0 END), 6) AS {name} FROM {rel} WHERE {c} IS NOT NULL AND {where} GROUP BY {c}"


def cross(rel, c):
    return (f"SELECT {c}, " + ", ".join(
        f"count(*) FILTER (WHERE readmitted = '{v}') AS \"{v}\"" for v in ("<30", ">30", "NO"))
        + f" FROM {rel} GROUP BY {c}")


def class_stats(rel, columns, group, places):
    return union_all(
        f"SELECT '{c}' AS \"column\", {group}, round(avg({c}), {places}) AS mean, round(quantile_cont({c}, 0.5), {places}) AS median, "
        f"round(stddev_samp({c}), {places}) AS std, round(min({c}), {places}) AS min, round(max({c}), {places}) AS max FROM {rel} GROUP BY {group}"
        for c in columns)


def hist(rel, columns, bins, places, group=None):
    g = f"{group}, " if group else ""
    on = f"r.{group} = s.{group} AND " if group else ""

    def one(c):
        return (
            f"SELECT {('s.' + group + ', ') if group else ''}'{c}' AS \"column\", b AS bin, "
            f"round(lo + b * ((hi - lo) / {bins}), {places}) AS left_edge, round(lo + (b + 1) * ((hi - lo) / {bins}), {places}) AS right_edge, "
            f"(SELECT count(*) FROM {rel} r WHERE {on}least(floor((CAST(r.{c} AS DOUBLE) - lo) / ((hi - lo) / {bins})), {bins - 1}) = b) AS n "
            f"FROM (SELECT {g}CASE WHEN min({c}) = max({c}) THEN min({c}) - 0.5 ELSE min({c}) END::DOUBLE AS lo, "
            f"CASE WHEN min({c}) = max({c}) THEN max({c}) + 0.5 ELSE max({c}) END::DOUBLE AS hi FROM {rel}{' GROUP BY ' + group if group else ''}) s, "
            f"(SELECT CAST(range AS INT) AS b FROM range({bins})) k")
    return union_all(one(c) for c in columns)


def box(rel, c, group, places):
    return f"""SELECT {group}, round(q1, {places}) AS q1, round(m, {places}) AS median, round(q3, {places}) AS q3,
  round(min({c}) FILTER (WHERE {c} >= q1 - 1.5::DOUBLE * (q3 - q1) AND {c} <= q3 + 1.5::DOUBLE * (q3 - q1)), {places}) AS whisker_low,
  round(max({c}) FILTER (WHERE {c} >= q1 - 1.5::DOUBLE * (q3 - q1) AND {c} <= q3 + 1.5::DOUBLE * (q3 - q1)), {places}) AS whisker_high,
  count(*) FILTER (WHERE NOT ({c} >= q1 - 1.5::DOUBLE * (q3 - q1) AND {c} <= q3 + 1.5::DOUBLE * (q3 - q1))) AS fliers
FROM {rel} JOIN (SELECT {group}, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS m, quantile_cont({c}, 0.75) AS q3 FROM {rel} GROUP BY {group}) q USING ({group})
GROUP BY {group}, q1, m, q3"""


def corr(a, b, rel, places=6):
    a, b = f"CAST({a} AS DOUBLE)", f"CAST({b} AS DOUBLE)"
    return f"round(covar_pop({a}, {b}) / nullif(stddev_pop({a}) * stddev_pop({b}), 0), {places})"


def matrix(rel, columns):
    return union_all(
        f"SELECT '{a}' AS x, '{b}' AS y, {corr(a, b, rel)} AS r FROM {rel}"
        for a in columns for b in columns)


def target(rel, columns, places=6):
    return union_all(f"SELECT '{c}' AS \"column\", {corr(c, 'tc', rel, places)} AS r FROM {rel}" for c in columns)


def value_shares(rel, columns):
    return union_all(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n, round(count(*)::DOUBLE / (SELECT count({c}) FROM {rel}), 6) AS share "
        f"FROM {rel} WHERE {c} IS NOT NULL AND (SELECT count(DISTINCT {c}) FROM {rel}) <= 20 GROUP BY {c}" for c in columns)


def scaled_cols(columns):
    return "sca AS MATERIALIZED (SELECT spl.* REPLACE ({}) FROM spl, (SELECT {} FROM spl WHERE split = 'train') k)".format(
        ", ".join(f"({c} - {c}_m) / CASE WHEN {c}_s = 0 THEN 1 ELSE {c}_s END AS {c}" for c in columns),
        ", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in columns))


_P = _T.replace("feat_t", "prep_t").replace("FROM feat", "FROM prep")
_bands = [f"[{i}-{i + 10})" for i in range(0, 120, 10)]
_left = sorted(set(COLUMN_ORDER) - set(NUMERIC) - {"readmitted", "encounter_id", "patient_nbr"})

_GAPS = "gaps AS (SELECT payer_code, {} FROM tok)".format(", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC))
SQL = {
    "agg01_class_shares": upto("prep", shares("prep", "readmitted")),
    "agg01_race_shares": upto("prep", shares("prep", "race")),
    "agg02_imbalance": upto("prep", "SELECT max(n) AS largest, min(n) AS smallest, round(max(n)::DOUBLE / min(n), 6) AS imbalance_ratio FROM (SELECT count(*) AS n FROM prep GROUP BY readmitted) t"),
    "agg03_rate_by_gender": upto("prep", rate("prep", "gender")),
    "agg03_rate_by_race": upto("prep", rate("prep", "race")),
    "agg03_rate_by_comorbidity": upto("feat", rate("feat", "comorbidity_index", "readmitted = '<30'", "early_rate")),
    "agg04_cross_tab": upto("prep", cross("prep", "gender")),
    "agg04_age_by_class": upto("prep", cross("prep", "age")),
    "agg05_stay_by_class": upto("prep", "SELECT readmitted, round(avg(time_in_hospital), 2) AS mean, round(quantile_cont(time_in_hospital, 0.5), 2) AS median, round(stddev_samp(time_in_hospital), 2) AS std FROM prep GROUP BY readmitted"),
    "agg06_class_stats": upto("prep", class_stats("prep", NUMERIC, "readmitted", 3)),
    "agg06_class_stats_gaps": upto("tok", class_stats("gaps", NUMERIC[:3], "payer_code", 3), _GAPS),
    "agg06_class_stats_gaps_spread": upto("tok", class_stats("gaps", NUMERIC[:3], "payer_code", 3), _GAPS),
    "agg10_histogram_gaps": upto("tok", hist("gaps", ["time_in_hospital"], 14, 6, "payer_code").replace("r.payer_code = s.payer_code", "r.payer_code IS NOT DISTINCT FROM s.payer_code"), _GAPS),
    "agg11_box_stats_gaps": upto("tok", box("gaps", "number_inpatient", "payer_code", 6).replace("q USING (payer_code)", "q ON gaps.payer_code IS NOT DISTINCT FROM q.payer_code").replace("SELECT payer_code, round(q1", "SELECT gaps.payer_code, round(q1").replace("GROUP BY payer_code, q1, m, q3", "GROUP BY gaps.payer_code, q1, m, q3"), _GAPS),
    "agg06_class_stats_lineitem": class_stats("lineitem", MEASURES, "l_returnflag", 3),
    "agg07_part_stats": upto("spl", union_all(
        f"SELECT split, '{c}' AS \"column\", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min, round(max({c}), 4) AS max, "
        + ", ".join(f"round(quantile_cont({c}, {q}), 4) AS p{int(q * 100)}" for q in (.25, .5, .75)) + " FROM sca GROUP BY split"
        for c in _SCALED), scaled_cols(_SCALED)),
    "agg09_histograms": upto("prep", hist("prep", NUMERIC, 30, 6)),
    "agg09_price_histogram": hist("orders", ["o_totalprice"], 25, 4),
    "agg10_histogram_by_class": upto("prep", hist("prep", ["number_diagnoses", "time_in_hospital"], 14, 6, "readmitted")),
    "agg11_box_stats": upto("prep", box("prep", "number_inpatient", "readmitted", 6)),
    "agg11_box_stats_price": box("lineitem", "l_extendedprice", "l_returnflag", 4),
    "agg12_correlation_matrix": upto("prep", matrix("prep", NUMERIC)),
    "agg12_feature_correlation_matrix": upto("feat", matrix("feat", ENGINEERED[:15])),
    "agg13_target_correlation": upto("prep", target("prep_t", NUMERIC), _P),
    "agg14_value_shares": upto("prep", value_shares("prep", ["number_inpatient", "gender", "diag_1", "age"])),
    "agg17_ordered_ages": upto("prep", union_all(
        f"SELECT {i} AS position, '{b}' AS value, (SELECT count(*) FROM prep WHERE age = '{b}') AS n" for i, b in enumerate(_bands))),
    "srt01_sorted_rates": upto("prep", rate("prep", "payer_code")),
    "srt02_sorted_by_size": upto("feat", f"SELECT * FROM ({target('feat_t', ENGINEERED)}) t WHERE r IS NOT NULL", _T),
    "flt08_defined_correlations": upto("feat", f"SELECT \"column\" FROM ({target('feat_t', ENGINEERED)}) t WHERE r IS NOT NULL", _T),
    "top01_top_diagnoses": upto("prep", "SELECT diag_1, count(*) AS n FROM prep GROUP BY diag_1 ORDER BY n DESC, diag_1 LIMIT 15"),
    "top01_top_brands": "SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 10",
    "top02_strongest_features": upto("feat", f"SELECT \"column\", round(r, 5) AS r, round(abs(r), 5) AS abs_r FROM ({target('feat_t', ENGINEERED, 12)}) t WHERE r IS NOT NULL ORDER BY abs(r) DESC, \"column\" LIMIT 5", _T),
    "top02_strongest_measures": upto("prep", f"SELECT \"column\", round(r, 5) AS r, round(abs(r), 5) AS abs_r FROM ({target('prep_t', NUMERIC, 12)}) t WHERE r IS NOT NULL ORDER BY abs(r) DESC, \"column\" LIMIT 3", _P),
    "smp01_seeded_sample": upto("prep", "SELECT encounter_id, time_in_hospital, num_medications FROM prep ORDER BY md5(CAST(encounter_id AS VARCHAR) || ':42') LIMIT 3000"),
    "jn01_code_lookup": "SELECT c_custkey, coalesce(n_name, 'unknown') AS n_name, coalesce(r_name, 'unknown') AS r_name FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey",
    "jn03_label_alignment": upto("lab", "SELECT encounter_id, comorbidity_index, age_midpoint, label FROM lab"),
    "jn04_rate_of_top_codes": upto("prep", rate("prep", "diag_1", where="diag_1 IN (SELECT diag_1 FROM prep GROUP BY diag_1 ORDER BY count(*) DESC, diag_1 LIMIT 10)")),
    "jn04_rate_of_top_codes_all_positions": upto("prep", union_all(
        f"SELECT {c} AS code, n, rate, '{c}' AS position FROM (" + rate("prep", c, where=f"{c} IN (SELECT {c} FROM prep GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 10)") + ") t"
        for c in ("diag_1", "diag_2", "diag_3"))),
    "jn06_before_after": upto("prep", union_all(
        [f"SELECT '{c}' AS \"column\", (SELECT count(DISTINCT {c}) FROM tok) AS \"before\", (SELECT count(DISTINCT {c}) FROM prep) AS \"after\"" for c in ("race", "payer_code", "max_glu_serum", "diag_1")]
        + ["SELECT 'gender' AS \"column\", NULL::BIGINT AS \"before\", (SELECT count(DISTINCT gender) FROM prep) AS \"after\""])),
    "set02_key_overlap": upto("spl", """SELECT (SELECT count(*) FROM (SELECT encounter_id FROM spl WHERE split='train' INTERSECT SELECT encounter_id FROM spl WHERE split='val') a) AS train_val,
 (SELECT count(*) FROM (SELECT encounter_id FROM spl WHERE split='train' INTERSECT SELECT encounter_id FROM spl WHERE split='test') a) AS train_test,
 (SELECT count(*) FROM (SELECT encounter_id FROM spl WHERE split='val' INTERSECT SELECT encounter_id FROM spl WHERE split='test') a) AS val_test"""),
    "set05_side_by_side": upto("prep", "SELECT readmitted, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM prep) * 100, 2) AS pct, round(avg(time_in_hospital), 6) AS mean FROM prep GROUP BY readmitted"),
    "set04_columns_left": upto("enc", union_all(f"SELECT '{c}' AS \"column\", (SELECT count(*) FROM enc) AS row_count" for c in _left)),
}
