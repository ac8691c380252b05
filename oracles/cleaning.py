"""SQL for profiling, imputation, de-duplication and outliers."""

from __future__ import annotations

from oracles.blocks import GAPPED, upto, union_all
from wardline.operators.features import ENGINEERED
from wardline.sources.layout import (
    CODED,
    COLUMN_ORDER, KEY, LABEL_CODED, NOT_MODELLED, NUMERIC, PATIENT,
)

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_LINEITEM = [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
             ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
             ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
             ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")]


def nulls(rel: str) -> str:
    return union_all(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS missing_count, "
        f"round(100.0::DOUBLE * count(*) FILTER (WHERE {c} IS NULL) / count(*), 2) AS missing_pct FROM {rel}"
        for c in COLUMN_ORDER)


def describe_text(rel: str, c: str) -> str:
    return (
        f"SELECT '{c}' AS \"column\", CAST(sum(n) AS BIGINT) AS \"count\", count(*) AS \"unique\", "
        f"arg_min(v, (-n, v)) AS top, max(n) AS freq, NULL::DOUBLE AS mean, NULL::DOUBLE AS std, "
        f"NULL::DOUBLE AS min, NULL::DOUBLE AS max, NULL::DOUBLE AS p25, NULL::DOUBLE AS p50, NULL::DOUBLE AS p75 "
        f"FROM (SELECT {c} AS v, count(*) AS n FROM {rel} WHERE {c} IS NOT NULL GROUP BY {c}) t")


def describe_number(rel: str, c: str, places: int) -> str:
    r = lambda e: f"round({e}, {places})"
    return (
        f"SELECT '{c}' AS \"column\", count({c}) AS \"count\", NULL::BIGINT AS \"unique\", NULL::VARCHAR AS top, "
        f"NULL::BIGINT AS freq, {r(f'avg({c})')} AS mean, {r(f'stddev_samp({c})')} AS std, "
        f"{r(f'CAST(min({c}) AS DOUBLE)')} AS min, {r(f'CAST(max({c}) AS DOUBLE)')} AS max, "
        + ", ".join(f"{r(f'CAST(quantile_cont({c}, {q}) AS DOUBLE)')} AS p{int(q * 100)}" for q in (.25, .5, .75))
        + f" FROM {rel}")


def outliers(rel: str, columns, places: int) -> str:
    def one(c):
        return (
            f"SELECT '{c}' AS \"column\", round(q1, {places}) AS q1, round(q3, {places}) AS q3, round(q3 - q1, {places}) AS iqr, "
            f"round(q1 - 1.5::DOUBLE * (q3 - q1), {places}) AS lower_fence, round(q3 + 1.5::DOUBLE * (q3 - q1), {places}) AS upper_fence, "
            f"round(a, {places}) AS cap_lower, round(b, {places}) AS cap_upper, "
            f"(SELECT count(*) FROM {rel} WHERE {c} < q1 - 1.5::DOUBLE * (q3 - q1) OR {c} > q3 + 1.5::DOUBLE * (q3 - q1)) AS outliers_found "
            f"FROM (SELECT quantile_cont({c}, 0.01) AS a, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3, quantile_cont({c}, 0.99) AS b FROM {rel}) t")
    return union_all(one(c) for c in columns)


def winsor(rel: str, keys, columns) -> str:
    caps = ", ".join(f"quantile_cont({c}, 0.01) AS {c}_a, quantile_cont({c}, 0.99) AS {c}_b" for c in columns)
    cut = ", ".join(f"round(greatest({c}_a, least({c}_b, {c})), 4) AS {c}" for c in columns)
    return f"SELECT {', '.join(keys)}, {cut} FROM {rel}, (SELECT {caps} FROM {rel}) k"


def validation(feature: str) -> str:
    f = f"CAST({feature} AS DOUBLE)"
    both = f"FILTER (WHERE {feature} IS NOT NULL)"
    return (
        f"SELECT '{feature}' AS feature, round(avg(CAST({feature} IS NULL AS INT)) * 100, 2) AS missing_pct, "
        f"count(DISTINCT {feature}) AS unique_values, round(avg({f}), 6) AS mean, round(stddev_samp({f}), 6) AS std, "
        f"round(covar_pop({f}, tc) / nullif(stddev_pop({f}) * stddev_pop(tc) {both}, 0), 6) AS corr_target FROM feat_t")


_T = "feat_t AS (SELECT *, CAST(CASE readmitted WHEN '<30' THEN 0 WHEN '>30' THEN 1 WHEN 'NO' THEN 2 END AS DOUBLE) AS tc FROM feat)"
MODEL = [c for c in COLUMN_ORDER if c not in NOT_MODELLED + [KEY, PATIENT, "readmitted"]] + ENGINEERED

_WHOLE = NUMERIC + CODED + [KEY, PATIENT]
SQL = {
    "prf01_table_profile": union_all(
        f"SELECT '{c}' AS \"column\", '{t}' AS dtype, {i} AS position, (SELECT count(*) FROM lineitem) AS row_count, {len(_LINEITEM)} AS column_count"
        for i, (c, t) in enumerate(_LINEITEM)),
    "prf02_null_profile": upto("tok", nulls("tok")),
    "prf02_top_gaps": upto("tok", f"SELECT * FROM ({nulls('tok')}) t WHERE missing_count > 0 ORDER BY missing_pct DESC, \"column\" LIMIT 20"),
    "prf03_duplicate_count": "SELECT CAST(sum(n) AS BIGINT) AS row_count, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) t",
    "prf03_duplicate_rows": "SELECT CAST(sum(n) AS BIGINT) AS row_count, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM (SELECT *, count(*) AS n FROM lineitem GROUP BY ALL) t",
    "prf04_describe_all": upto("tok", union_all(
        [describe_text("tok", c) for c in COLUMN_ORDER if c not in _WHOLE] + [describe_number("tok", c, 6) for c in COLUMN_ORDER if c in _WHOLE])),
    "prf04_describe_encounters": upto("tok", union_all(
        [describe_text("tok", c) for c in ("race", "gender", "payer_code", "diag_1", "insulin", "readmitted")]
        + [describe_number("tok", c, 6) for c in NUMERIC])),
    "prf04_describe_lineitem": union_all(
        [describe_text("lineitem", c) for c in ("l_returnflag", "l_linestatus")]
        + [describe_number("lineitem", c, 4) for c in MEASURES]),
    "prf05_null_mask": upto("tok", "SELECT encounter_id, " + ", ".join(
        f"CAST({c} IS NULL AS INT) AS {c}" for c in GAPPED)
        + " FROM tok ORDER BY md5(CAST(encounter_id AS VARCHAR) || ':42') LIMIT 500"),
    "prf06_columns_per_type": upto("enc", """SELECT dtype, CAST(n AS BIGINT) AS n_columns FROM (VALUES ('bigint', 2), ('int', 11), ('string', 37)) v(dtype, n)
WHERE (SELECT count(*) FROM enc) > 0"""),
    "prf07_null_change": upto("prep", union_all(
        f"SELECT '{c}' AS \"column\", (SELECT count(*) FROM tok WHERE {c} IS NULL) AS \"before\", (SELECT count(*) FROM prep WHERE {c} IS NULL) AS \"after\""
        for c in GAPPED)),
    "prf08_quality_score": upto("prep", """SELECT rb AS rows_before, ra AS rows_after, rb - ra AS rows_removed, nb AS nulls_before, na AS nulls_after,
  round((1 - na::DOUBLE / greatest(ra * 50, 1)) * 100, 2) AS quality_score
FROM (SELECT (SELECT count(*) FROM tok) AS rb, (SELECT count(*) FROM prep) AS ra,
  (SELECT CAST(sum(""" + " + ".join(f"CAST({c} IS NULL AS INT)" for c in COLUMN_ORDER) + """) AS BIGINT) FROM tok) AS nb,
  (SELECT CAST(sum(""" + " + ".join(f"CAST({c} IS NULL AS INT)" for c in COLUMN_ORDER) + """) AS BIGINT) FROM prep) AS na) t"""),
    "prf09_null_check": upto("spl", "SELECT split, count(*) AS n_rows, CAST(sum(" + " + ".join(
        f"CAST({c} IS NULL AS INT)" for c in MODEL) + ") AS BIGINT) AS n_null, CASE WHEN sum(" + " + ".join(
        f"CAST({c} IS NULL AS INT)" for c in MODEL) + ") = 0 THEN 'OK' ELSE 'WARN' END AS status FROM spl GROUP BY split"),
    "prf10_distinct_counts": upto("tok", union_all(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM tok" for c in LABEL_CODED + ["diag_1", "weight"])),
    "prf11_feature_validation": upto("feat", union_all(validation(f) for f in ENGINEERED), _T),
    "prf12_feature_kinds": upto("feat", union_all(
        f"SELECT '{f}' AS feature, CASE WHEN count(DISTINCT {f}) = 2 THEN 'binary' ELSE 'continuous' END AS feature_type FROM feat" for f in ENGINEERED)),
    "prf13_model_kinds": upto("spl", union_all(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct, CASE WHEN count(DISTINCT {c}) <= 10 OR {str(c in LABEL_CODED).lower()} THEN 'categorical' ELSE 'numerical' END AS kind FROM spl WHERE split = 'train'"
        for c in MODEL)),
    "prf14_column_totals": upto("feat", "SELECT count(*) AS row_count, 50 AS original, 48 AS engineered, 98 AS total FROM feat"),
    "cln01_median_impute": upto("enc", """SELECT encounter_id, coalesce(a, (SELECT quantile_cont(a, 0.5) FROM n)) AS diag_1, coalesce(b, (SELECT quantile_cont(b, 0.5) FROM n)) AS diag_2 FROM n""",
        "n AS (SELECT encounter_id, TRY_CAST(diag_1 AS DOUBLE) AS a, TRY_CAST(diag_2 AS DOUBLE) AS b FROM enc)"),
    "cln02_mode_impute": upto("imp", f"SELECT encounter_id, {', '.join(GAPPED)} FROM imp"),
    "cln03_imputation_log": upto("tok", union_all(
        f"(SELECT '{c}' AS \"column\", 'mode' AS strategy, {c} AS value FROM tok WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)" for c in GAPPED)),
    "cln04_distinct_whole_rows": "SELECT DISTINCT * FROM lineitem",
    "cln04_distinct_rows": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    "cln04_duplicate_samples": "SELECT l_orderkey, l_linenumber, count(*) - 1 AS surplus FROM lineitem GROUP BY ALL HAVING count(*) > 1 ORDER BY l_orderkey, l_linenumber LIMIT 5",
    "cln05_constant_fill": upto("tok", "SELECT encounter_id, coalesce(weight, '0') AS weight, coalesce(payer_code, 'none') AS payer_code FROM tok"),
    "cln_imputed_and_typed": upto("imp", "SELECT * FROM imp"),
    "out01_outlier_report": upto("imp", outliers("imp", NUMERIC, 6)),
    "out01_outlier_report_lineitem": outliers("lineitem", MEASURES, 4),
    "out02_winsorised": upto("prep", f"SELECT encounter_id, {', '.join(NUMERIC)} FROM prep"),
    "out02_winsorised_lineitem": winsor("lineitem", ["l_orderkey", "l_linenumber"], MEASURES),
}
