"""SQL for the report tables of a run, observed figures and incremental profiles."""

from __future__ import annotations

from oracles import cleaning, exploring, features, scoring
from oracles.blocks import GAPPED, upto, union_all
from wardline.sources.layout import CODED, COLUMN_ORDER, KEY, NUMERIC, PATIENT

_NUMBERS = [KEY, PATIENT, *NUMERIC, *CODED]


def _gaps(c: str) -> str:
    def of(rel, stage):
        return (f"(SELECT count(*) FILTER (WHERE {c} IS NULL) FROM {rel}) AS missing_{stage}, "
                f"(SELECT round(100.0::DOUBLE * count(*) FILTER (WHERE {c} IS NULL) / count(*), 2) FROM {rel}) AS pct_{stage}")
    return f"SELECT '{c}' AS \"column\", {of('tok', 'before')}, {of('uni', 'after')}"


def _summary(c: str) -> str:
    number = c in _NUMBERS
    value = f"CAST({c} AS DOUBLE)"
    figures = ", ".join(
        f"{e.format(v=value) if number else 'NULL::DOUBLE'} AS {n}" for n, e in (
            ("mean", "round(avg({v}), 6)"), ("std", "round(stddev_samp({v}), 6)"), ("min", "min({v})"), ("max", "max({v})")))
    return (f"SELECT '{c}' AS \"column\", count(*) AS n, count(*) FILTER (WHERE {c} IS NULL) AS missing_count, "
            f"round(100.0::DOUBLE * count(*) FILTER (WHERE {c} IS NULL) / count(*), 2) AS missing_pct, {figures} FROM tok")


SQL = {
    "prf02_observed_gaps": upto("uni", union_all(map(_gaps, COLUMN_ORDER))),
    "prf08_observed_quality": cleaning.SQL["prf08_quality_score"],
    "cln03_observed_imputation": upto("tok", union_all(
        f"(SELECT '{c}' AS \"column\", 'mode' AS strategy, {c} AS value, (SELECT count(*) FILTER (WHERE {c} IS NULL) FROM tok) AS n_filled FROM tok WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
        for c in GAPPED)),
    "snk06_initial_quality": cleaning.SQL["prf04_describe_all"],
    "snk06_class_statistics": exploring.SQL["agg06_class_stats"],
    "snk06_feature_validation": cleaning.SQL["prf11_feature_validation"],
    "snk06_feature_kinds": cleaning.SQL["prf12_feature_kinds"],
    "snk06_split_summary": features.SQL["agg08_split_summary"],
    "snk06_split_statistics": exploring.SQL["agg07_part_stats"],
    "snk06_model_comparison": scoring.SQL["ml12_model_comparison"],
    "prf04_incremental_profile": upto("tok", union_all(map(_summary, COLUMN_ORDER))),
    "prf10_incremental_distinct": upto("tok", union_all(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS exact, true AS close FROM tok" for c in COLUMN_ORDER)),
    "agg09_incremental_histogram": upto("tok", union_all(
        f"SELECT '{c}' AS \"column\", 10::BIGINT AS bins, count({c})::BIGINT AS n, min({c})::DOUBLE AS low, max({c})::DOUBLE AS high FROM tok" for c in NUMERIC)),
}
