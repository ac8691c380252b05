"""The feed of scored records: assembly, append, merge, display and summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.operators.features import glucose_category
from wardline.operators.score import POLICIES, allocate, tier, with_rule_score

STATUSES = ["LOW", "MODERATE", "HIGH"]


def assemble(inputs: DataFrame) -> DataFrame:
    """Scored records: score, tier under the assessment policy, care-team member.

    Inputs without a ``risk_score`` get the rule-based one.
    """
    scored = inputs if "risk_score" in inputs.columns else with_rule_score(inputs)
    tiered = scored.withColumn("status", tier(F.col("risk_score"), POLICIES["assessment"]))
    return allocate(tiered).select(
        F.col("encounter_id").alias("record_id"),
        F.col("recorded_at").alias("timestamp"), "patient_name", "phone", "age",
        "risk_score", F.col("time_in_hospital").alias("los"), "status", "allocated_doctor",
        "blood_group", "fasting_blood_sugar",
        glucose_category(F.col("fasting_blood_sugar")).alias("glucose_category"),
    )


def append(records: DataFrame, path: str) -> None:
    records.write.mode("append").parquet(path)


def newest(records: DataFrame, n: int, key: str = "record_id") -> DataFrame:
    """The ``n`` newest records; equal times in key order."""
    return records.orderBy(F.desc("timestamp"), key).limit(n)


def merged_feed(
    stored: DataFrame, local: DataFrame, on: Sequence[str] = ("record_id",), keep: int = 100
) -> DataFrame:
    """Newest stored records and local ones not among them, newest first."""
    recent = newest(stored, keep)
    # At most ``keep`` rows on the right side.
    unseen = local.join(F.broadcast(recent.select(*on)), list(on), "left_anti")
    return recent.unionByName(unseen, allowMissingColumns=True).orderBy(
        F.desc("timestamp"), "record_id")


def with_status(records: DataFrame, status: str) -> DataFrame:
    return records if status == "ALL" else records.where(F.col("status") == status)


def _patient():
    return F.lower(F.trim("patient_name"))


def history_of(records: DataFrame, name: str) -> DataFrame:
    """Records of one patient, by trimmed and case-folded name."""
    return records.where(_patient() == name.strip().lower())


def latest_per_patient(records: DataFrame) -> DataFrame:
    """The newest record of each patient, by the name the history goes by; combined before
    the shuffle."""
    newest_first = F.struct(F.col("timestamp"), -F.col("record_id"))
    fields = ["patient_name", *[c for c in records.columns if c != "patient_name"]]
    return records.groupBy(_patient().alias("_patient")).agg(
        F.max_by(F.struct(*fields), newest_first).alias("_r")).select("_r.*")


def totals(records: DataFrame) -> DataFrame:
    """Total, mean risk and HIGH count; zeros for an empty feed."""
    risk = F.coalesce(F.col("risk_score"), F.lit(0.0))
    return records.agg(
        F.count("*").alias("total_analyzed"),
        F.coalesce(F.round(F.avg(risk), 1), F.lit(0.0)).alias("avg_risk"),
        F.count_if(F.col("status") == "HIGH").alias("high_risk_alerts"),
    )


def status_counts(records: DataFrame) -> DataFrame:
    """Counts per upper-cased status; the known ones always appear, others are kept."""
    found = records.groupBy(
        F.upper(F.coalesce("status", F.lit("LOW"))).alias("status")
    ).agg(F.count("*").alias("n"))
    listed = records.sparkSession.createDataFrame([(s, 0) for s in STATUSES], "status string, n bigint")
    return found.unionByName(listed).groupBy("status").agg(F.sum("n").alias("n"))


def display(records: DataFrame) -> DataFrame:
    """Formatted feed rows, with defaults for what is missing."""
    return records.select(
        F.date_format("timestamp", "yyyy-MM-dd HH:mm").alias("date"),
        F.coalesce("patient_name", F.lit("Unknown")).alias("patient"),
        F.coalesce("age", F.lit("N/A")).alias("age_group"),
        F.format_string("%.1f%%", F.coalesce("risk_score", F.lit(0.0))).alias("risk"),
        F.coalesce("status", F.lit("N/A")).alias("status"),
        F.coalesce("allocated_doctor", F.lit("Unassigned")).alias("doctor"),
    )


def follow_up_list(scored: DataFrame, probability: str = "probability", bound: float = 0.5
                   ) -> DataFrame:
    """Rows above the follow-up bound."""
    return scored.where(F.col(probability) > bound)


def cohort_trend(scored: DataFrame, probability: str = "probability", bound: float = 0.5
                 ) -> DataFrame:
    """Monthly size and early-return rate of the rows above the bound."""
    return follow_up_list(scored, probability, bound).groupBy(
        F.date_format("timestamp", "yyyy-MM").alias("month")
    ).agg(
        F.count("*").alias("n"),
        (F.avg("label") * 100).alias("readmission_rate"),
    )
