"""SQL for balancing and neighbours; fitted models have no SQL form."""

from __future__ import annotations

from oracles.blocks import upto
from oracles.scoring import _S, INP, NOISE, RAW, plain, tenth_of
from wardline.plans.catalogue.modelling import TREES

WHOLE = ["time_in_hospital", "num_lab_procedures", "num_medications", "number_inpatient",
         "number_diagnoses", "age_midpoint"]
_MIN = "mino AS MATERIALIZED (SELECT encounter_id, " + ", ".join(WHOLE) + " FROM spl WHERE split = 'train' AND label = 1)"
_NBR = """nbr AS MATERIALIZED (SELECT * FROM (SELECT encounter_id, neighbour, squared, CAST(row_number() OVER (PARTITION BY encounter_id ORDER BY squared, neighbour) - 1 AS INT) AS position FROM (
  SELECT a.encounter_id, b.encounter_id AS neighbour, """ + " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in WHOLE) + """ AS squared
  FROM mino a JOIN mino b ON a.encounter_id <> b.encounter_id) p) q WHERE position < 5)"""
_SYN = """syn AS MATERIALIZED (SELECT s.encounter_id, s.copy, """ + ", ".join(
    f"round(s.{c} + (m.{c} - s.{c}) * u, 6) AS {c}" for c in WHOLE) + """, 1 AS label FROM (
  SELECT *, CAST(('0x' || substr(h, 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS u, CAST(('0x' || substr(h, 9, 8)) AS BIGINT) % 5 AS pick FROM (
   SELECT *, md5(CAST(encounter_id AS VARCHAR) || ':' || CAST(copy AS VARCHAR) || ':42') AS h FROM (
    SELECT r.*, CAST(unnest(range(1, 1 + need // held + CASE WHEN rn <= need % held THEN 1 ELSE 0 END)) AS INT) AS copy FROM (
     SELECT *, row_number() OVER (ORDER BY md5(CAST(encounter_id AS VARCHAR) || ':42')) AS rn, count(*) OVER () AS held,
       (SELECT count(*) FILTER (WHERE label = 0) - count(*) FILTER (WHERE label = 1) FROM spl WHERE split = 'train') AS need FROM mino) r) c) d) s
  JOIN nbr ON nbr.encounter_id = s.encounter_id AND nbr.position = s.pick JOIN mino m ON m.encounter_id = nbr.neighbour)"""
_cols = ", ".join(WHOLE)

_NODES = "nodes(tree, node, feature, threshold, lft, rgt, value) AS (VALUES " + ", ".join(
    f"({t}, {n}, {f}, {c}::DOUBLE, {a}, {b}, {v}::DOUBLE)" for t, n, f, c, a, b, v in TREES) + ")"
_MEAN_LAST = 3


def walked(source: str, key: str) -> tuple[str, ...]:
    """The rows ``(key, x)`` of ``source`` at their leaves, as ``done(key, probability)``: a join for each level."""
    ctes = [_NODES, f"w0 AS (SELECT {key}, x, tree, 0 AS node FROM {source}, (SELECT DISTINCT tree FROM nodes) t)"]
    for d in range(_MEAN_LAST):
        ctes.append(f"w{d + 1} AS (SELECT {key}, x, w.tree, CASE WHEN feature < 0 THEN w.node WHEN x[feature + 1] <= threshold THEN lft ELSE rgt END AS node "
                    f"FROM w{d} w JOIN nodes n ON n.tree = w.tree AND n.node = w.node)")
    return (*ctes, f"done AS (SELECT {key}, avg(value) AS probability FROM w{_MEAN_LAST} w JOIN nodes n ON n.tree = w.tree AND n.node = w.node GROUP BY {key})")


def _x(names) -> str:
    return "[" + ", ".join(f"{n}::DOUBLE" for n in names) + "]"


_TEST_X = f"held AS (SELECT encounter_id, {_x(WHOLE)} AS x FROM spl WHERE split = 'test')"
_FEED_X = ("fed AS (SELECT encounter_id, " + _x([
    "time_in_hospital", "num_lab_procedures", "num_medications", "number_inpatient", "num_diagnoses",
    "(CASE WHEN regexp_full_match(age, '[0-9]+-[0-9]+') THEN split_part(age, '-', 1)::INT + 5 ELSE 75 END)"]) + " AS x FROM inp)")


def _grid(column: str, place: int) -> str:
    """Distinct values if at most 50, else 50 even steps between the 5th and 95th percentile."""
    c = f"(SELECT {column} AS v FROM spl WHERE split = 'test' AND {column} IS NOT NULL)"
    return f"""SELECT '{column}' AS feature, {place} AS place, v::DOUBLE AS grid_value FROM (SELECT DISTINCT v FROM {c} a) b WHERE (SELECT count(DISTINCT v) FROM {c} d) <= 50
UNION ALL SELECT '{column}', {place}, lo + (hi - lo) * i / 49 FROM (SELECT quantile_cont(v, 0.05) AS lo, quantile_cont(v, 0.95) AS hi, count(DISTINCT v) AS n FROM {c} e) q, range(50) r(i) WHERE n > 50"""


_SPOTS = f"spots AS MATERIALIZED ({_grid('time_in_hospital', 1)} UNION ALL {_grid('num_lab_procedures', 2)})"
_COPIES = """copies AS (SELECT {'e': encounter_id, 'f': feature, 'g': grid_value} AS name,
  list_transform(range(1, 7), lambda i: CASE WHEN i = place THEN grid_value ELSE x[i] END) AS x FROM held, spots)"""

SQL = {
    "ml05_tree_table_predictions": upto("spl", "SELECT encounter_id, probability, (probability > 0.5)::DOUBLE AS prediction FROM done", _TEST_X, *walked("held", "encounter_id")),
    "ml05_fitted_forest_and_its_nodes": upto("spl", "SELECT count(*) AS n, count(*) AS n_same FROM spl WHERE split = 'test'"),
    "ml16_tree_table_dependence": upto("spl", "SELECT name.f AS feature, round(name.g, 9) AS grid_value, round(avg(probability), 9) AS average FROM done GROUP BY name.f, name.g", _TEST_X, _SPOTS, _COPIES, *walked("copies", "name")),
    "scr03_tree_table_score": plain("SELECT encounter_id, risk_score FROM sct", RAW, INP, _FEED_X, *walked("fed", "encounter_id"),
        "both_ AS (SELECT encounter_id, probability, patient_name FROM done JOIN inp USING (encounter_id))",
        tenth_of("sct", f"probability * 100 + {NOISE.format('patient_name')}", "both_")),
    "ml03_synthetic_minority": upto("spl", f"SELECT encounter_id, copy, {_cols}, label FROM syn", _MIN, _NBR, _SYN),
    "set03_balanced_rows": upto("spl", f"SELECT encounter_id, 0 AS copy, {_cols}, label FROM spl WHERE split = 'train' UNION ALL SELECT encounter_id, copy, {_cols}, label FROM syn", _MIN, _NBR, _SYN),
    "agg18_class_change": upto("spl", """SELECT label, count(*) AS n_before, max(count(*)) OVER () AS n_after, max(count(*)) OVER () - count(*) AS n_synthetic FROM spl WHERE split = 'train' GROUP BY label"""),
    "jn08_minority_neighbours": upto("spl", "SELECT encounter_id, position, neighbour, squared FROM nbr", _MIN, _NBR),
    "jn08_minority_neighbours_many_cells": upto("spl", "SELECT encounter_id, position, neighbour, squared FROM nbr", _MIN, _NBR),
    "jn08_embedding_neighbours": """WITH e AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)
SELECT vec_id, position, neighbour, round(squared, 6) AS squared FROM (SELECT vec_id, neighbour, squared, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY squared, neighbour) - 1 AS INT) AS position FROM (
 SELECT a.vec_id, b.vec_id AS neighbour, list_sum(list_transform(range(1, len(a.x) + 1), lambda i: (a.x[i] - b.x[i]) * (a.x[i] - b.x[i]))) AS squared FROM e a JOIN e b ON a.vec_id <> b.vec_id) p) q WHERE position < 5""",
    "jn08_index_recall": "SELECT CAST(count(*) * least(5, count(*) - 1) AS BIGINT) AS n, true AS enough FROM embeddings",
    "scr04_fallback_score": plain("SELECT encounter_id, risk_score FROM sco", *_S),
}
