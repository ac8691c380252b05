"""SQL for sources, sinks, projections, casts and filters."""

from __future__ import annotations

from oracles.blocks import GAPPED, TOKENS, upto, union_all
from oracles.cleaning import MODEL
from wardline.sources.layout import CODED, COLUMN_ORDER, LABEL_CODED, NUMERIC

_nums = ", ".join(NUMERIC)

SQL = {
    "src01_csv_null_tokens": upto("tok", f"SELECT {', '.join(COLUMN_ORDER)} FROM tok"),
    "src01_scan_by_header_name": upto("tok", f"SELECT {', '.join(COLUMN_ORDER)} FROM tok WHERE encounter_id % 97 <> 0 AND encounter_id % 89 <> 0"),
    "src01_scan_rejects": upto("enc", "SELECT CASE WHEN encounter_id % 97 = 0 THEN 'fields' ELSE 'time_in_hospital' END AS reason, count(*) AS n FROM enc WHERE encounter_id % 97 = 0 OR encounter_id % 89 = 0 GROUP BY 1"),
    "src02_stage_csv": upto("prep", f"SELECT encounter_id, readmitted, {_nums} FROM prep"),
    "src03_first_rows": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 120",
    "src04_snapshot": "SELECT p_partkey, p_brand, p_type, p_size FROM part",
    "snk01_csv_round_trip": "SELECT * FROM customer",
    "snk02_json_mapping": upto("enc", union_all(
        f"SELECT '{c}' AS \"column\", value, CAST(row_number() OVER (ORDER BY value) - 1 AS INT) AS code FROM (SELECT DISTINCT {c} AS value FROM enc) t"
        for c in ("gender", "insulin", "change"))),
    "snk02_full_mapping": upto("prep", union_all(
        f"SELECT '{c}' AS \"column\", v AS value, CAST(row_number() OVER (ORDER BY v) - 1 AS INT) AS code FROM (SELECT DISTINCT coalesce(CAST({c} AS VARCHAR), 'nan') AS v FROM prep) t" for c in LABEL_CODED + ["readmitted"])),
    "snk02_feature_kinds": upto("spl", """SELECT string_agg(c, ',' ORDER BY c) FILTER (k = 'numerical') AS numerical, string_agg(c, ',' ORDER BY c) FILTER (k = 'categorical') AS categorical,
  CAST(count(*) FILTER (k = 'numerical') AS INT) AS n_numerical, CAST(count(*) FILTER (k = 'categorical') AS INT) AS n_categorical FROM (""" + union_all(
        f"SELECT '{c}' AS c, CASE WHEN count(DISTINCT {c}) <= 10 OR {str(c in LABEL_CODED).lower()} THEN 'categorical' ELSE 'numerical' END AS k FROM spl WHERE split = 'train'"
        for c in MODEL) + ") t"),
    "cst02_conversion_log": "SELECT * FROM (VALUES " + ", ".join([f"('{c}', 'int', 'double')" for c in NUMERIC] + [f"('{c}', 'int', 'string')" for c in CODED]) + ") t(\"column\", \"from\", \"to\")",
    "snk06_report_tables": upto("tok", union_all(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS missing_count, "
        f"round(100.0::DOUBLE * count(*) FILTER (WHERE {c} IS NULL) / count(*), 2) AS missing_pct FROM tok"
        for c in COLUMN_ORDER)),
    "prj01_drop_listed": "SELECT p_partkey, p_brand, p_type, p_size FROM part",
    "prj02_by_kind": "SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier",
    "prj04_rename": "SELECT n_nationkey AS nation_id, n_name AS nation_name FROM nation",
    "cst01_numeric_coercion": upto("enc", "SELECT encounter_id, TRY_CAST(diag_1 AS DOUBLE) AS diag_1, TRY_CAST(diag_2 AS DOUBLE) AS diag_2, TRY_CAST(weight AS DOUBLE) AS weight FROM enc"),
    "cst02_to_category": upto("enc", "SELECT encounter_id, " + ", ".join(
        f"CAST({c} AS VARCHAR) AS {c}" for c in CODED) + " FROM enc"),
    "cst03_flag": "SELECT l_orderkey, l_linenumber, CAST(l_quantity > 25 AS INT) AS large FROM lineitem",
    "flt01_class_value": upto("enc", "SELECT encounter_id, readmitted, time_in_hospital FROM enc WHERE readmitted <> 'NO'"),
    "flt02_in_list": "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')",
    "flt03_known_target": upto("enc", "SELECT encounter_id, CASE readmitted WHEN '<30' THEN 1 WHEN '>30' THEN 0 END AS label FROM enc WHERE readmitted IN ('<30', '>30')"),
    "flt04_known_values": upto("tok", "SELECT count(d) AS n, round(avg(d), 6) AS mean FROM (SELECT TRY_CAST(diag_2 AS DOUBLE) AS d FROM tok) t"),
    "flt07_outside_fences": """WITH f AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem, f
WHERE l_extendedprice < q1 - 0.5::DOUBLE * (q3 - q1) OR l_extendedprice > q3 + 0.5::DOUBLE * (q3 - q1)""",
}
