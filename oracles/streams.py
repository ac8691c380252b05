"""SQL of the batch results the bounded streams must equal."""

from __future__ import annotations

from oracles.scoring import _R, plain

SQL = {
    "str01_scored_stream": plain("SELECT * EXCLUDE (origin, label) REPLACE (strftime(timestamp, '%Y-%m-%d') AS timestamp) FROM rec", *_R),
    "str02_without_resent": plain("SELECT record_id, status FROM rec", *_R),
    "str02_resent_within_days": plain("SELECT record_id, status FROM rec", *_R),
    "scr12_follow_up_alerts": plain("""SELECT patient_name, m.i AS record_id, strftime(m.t, '%Y-%m-%d') AS timestamp FROM (
  WITH RECURSIVE al AS (
    SELECT patient_name, min({'t': timestamp, 'i': record_id}) AS m FROM high GROUP BY patient_name
    UNION ALL SELECT h.patient_name, min({'t': h.timestamp, 'i': h.record_id}) FROM al JOIN high h ON h.patient_name = al.patient_name AND h.timestamp >= al.m.t + INTERVAL 30 DAY GROUP BY h.patient_name)
  SELECT * FROM al) a""", *_R, "high AS MATERIALIZED (SELECT patient_name, record_id, timestamp FROM rec WHERE risk_score / 100 > 0.5)"),
    "str03_status_windows": "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS start, event_type AS status, count(*) AS n, round(avg(value), 6) AS avg_risk FROM events GROUP BY 1, 2",
}
