"""Risk scoring of a table of inputs: points, tiers, care teams, texts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.codes import digest_mod, first_match, mapped
from wardline.functions.stats import clamp, right_closed, with_rounded_tenth
from wardline.operators.features import AGE_CODES, AGE_EDGES, MEDICATION_CODES, STAY_CODES
from wardline.sources.layout import DRUG_COMBINATIONS, DRUGS

# Points, limits, codes, tiers, care team and texts of the score.
BASE_POINTS = 12.5
AGE_POINTS = {
    "0-10": 0, "10-20": 2, "20-30": 4, "30-40": 6, "40-50": 10,
    "50-60": 15, "60-70": 22, "70-80": 28, "80-90": 35, "90-100": 40,
}
AGE_POINTS_UNKNOWN = 15
AGE_FACTOR = 0.4
PRIOR_ADMISSION_POINTS, PRIOR_ADMISSION_MOST = 9.5, 45.0
STAY_POINTS, LAB_POINTS, MEDICATION_POINTS = 1.8, 0.12, 0.35
DIAGNOSIS_POINTS, DIAGNOSES_FREE = 2.5, 4
INSULIN_POINTS = {"up": 7.5, "down": 7.5, "steady": 3.0}
COMORBIDITY_POINTS, NO_MEDICATION_POINTS = 14.5, 5.0
LOWEST, HIGHEST = 5.2, 98.7
AGE_CODE = {f"{10 * i}-{10 * i + 10}": i for i in range(10)}
AGE_MIDDLE = {f"{10 * i}-{10 * i + 10}": 10 * i + 5 for i in range(10)}
GENDER_CODE = {"Female": 0, "Male": 1}
INSULIN_CODE = {"Down": 0, "No": 1, "Steady": 2, "Up": 3}
# Model columns that a scoring input does not have.
INPUT_DEFAULTS = {
    "race": 2, "admission_type_id": 1, "discharge_disposition_id": 1, "admission_source_id": 7,
    "num_procedures": 1, "number_outpatient": 0, "number_emergency": 0, "max_glu_serum": 0,
    "A1Cresult": 0, "has_primary_diagnosis": 1, "diagnosis_diversity": 3,
    "total_procedures": 1, "procedure_complexity_score": 1, "has_surgery": 1,
    "emergency_admission_flag": 0, "admission_type_risk_score": 3,
    "admission_source_risk": 3, "glucose_level_category": 0,
    "A1C_result_category": 0, "abnormal_lab_count": 0, "discharge_to_home_flag": 1,
    "discharge_with_services_flag": 0, "ama_discharge_flag": 0,
    "discharge_disposition_risk": 1, "emergency_elderly": 0,
}
# A policy lists (tier, bound, whether the bound itself belongs to the tier), highest first.
POLICIES = {
    "assessment": [("HIGH", 40, True), ("MODERATE", 25, True), ("LOW", None, True)],
    "sample": [("HIGH", 50, True), ("MODERATE", 25, True), ("LOW", None, True)],
    "demonstration": [("CRITICAL / HIGH RISK", 35, False), ("MODERATE RISK", 25, False),
                      ("LOW RISK", None, True)],
    "probability": [("HIGH", 0.5, False), ("MEDIUM", 0.3, False), ("LOW", None, True)],
    "follow_up": [("FOLLOW UP", 0.5, False), ("ROUTINE", None, True)],
}
CARE_TEAM = [
    ("HIGH", "Dr. Sarah Mitchell", "Critical Care Lead", "+1-555-0101"),
    ("MODERATE", "Dr. James Wilson", "General Practitioner", "+1-555-0102"),
    ("LOW", "Nurse Maria Garcia", "Discharge Coordinator", "+1-555-0103"),
]
RECOMMENDATIONS = [
    ("CRITICAL / HIGH RISK", "IMMEDIATE Care Coordination, Pharmacist Review, and Home Visit within 48h."),
    ("MODERATE RISK", "Scheduled follow-up call within 72h and PCP appointment within 7 days."),
    ("LOW RISK", "Standard discharge instructions and routine follow-up."),
]
FOLLOW_UPS = [
    ("HIGH", "Appointment recommended within 24-48 hours."),
    ("MODERATE", "Clinic visit recommended within 7 days."),
    ("LOW", "Contact the clinic if symptoms change or you have concerns."),
]
TOPICS = [
    ("greeting", ["hello", "hi", "hey", "greetings"], []),
    ("identity", ["who are you", "what are you", "what can you do"], []),
    ("cardiac", ["chest pain", "arm pain", "shortness of breath", "heart", "chest tight",
                 "palpitation"], []),
    ("meningitis", ["stiff neck", "meningitis"], ["headache"]),
    ("respiratory", ["fever", "cough", "sore throat", "cold", "flu", "sneeze", "runny nose",
                     "congestion", "breathing"], []),
    ("gastro", ["stomach", "nausea", "vomit", "diarrhea", "belly", "abdomen", "indigestion",
                "poop"], []),
    ("neuro", ["headache", "migraine", "dizzy", "dizziness", "head"], []),
    ("musculoskeletal", ["back pain", "muscle", "joint", "bone", "ache", "sprain", "knee",
                         "shoulder", "body ache"], []),
    ("exercise", ["exercise", "workout", "fitness", "gym", "active"], []),
    ("diet", ["diet", "food", "eat", "nutrition", "meal", "hungry"], []),
]
NO_TOPIC = "unrecognised"
NOTICE = ("Hi %s, this is %s. Your clinical analysis is complete. "
          "Risk Level: %s (%.1f%%). Our team will reach out shortly.")
# End of fixed values.


def name_noise(name: Column) -> Column:
    """A fixed offset in [-1, 1) from the patient's name."""
    return (digest_mod(name, 200) - 100) / F.lit(100.0)


def with_rule_score(df: DataFrame, name: str = "risk_score", noise: bool = True) -> DataFrame:
    """Add the rule-based score, clamped and rounded to one place."""
    beyond = F.greatest(F.lit(0), F.col("num_diagnoses") - DIAGNOSES_FREE)
    points = (
        F.lit(BASE_POINTS)
        + mapped(F.col("age"), AGE_POINTS, AGE_POINTS_UNKNOWN) * F.lit(AGE_FACTOR)
        + F.least(F.col("number_inpatient") * F.lit(PRIOR_ADMISSION_POINTS),
                  F.lit(PRIOR_ADMISSION_MOST))
        + F.col("time_in_hospital") * F.lit(STAY_POINTS)
        + F.col("num_lab_procedures") * F.lit(LAB_POINTS)
        + F.col("num_medications") * F.lit(MEDICATION_POINTS)
        + beyond * F.lit(DIAGNOSIS_POINTS)
        + mapped(F.lower("insulin"), INSULIN_POINTS, 0.0)
        + F.when(F.col("has_comorbidity"), COMORBIDITY_POINTS).otherwise(0.0)
        - F.when(F.col("on_medication"), 0.0).otherwise(NO_MEDICATION_POINTS)
    )
    if noise:
        points = points + name_noise(F.col("patient_name"))
    pointed = df.withColumn("_points", points)
    return with_rounded_tenth(
        pointed, name, clamp(F.col("_points"), LOWEST, HIGHEST)).drop("_points")


def tier(score: Column, policy: Sequence[tuple[str, float | None, bool]]) -> Column:
    """Tier of a score under a policy table."""
    chain, last = None, None
    for name, bound, inclusive in policy:
        if bound is None:
            last = name
            continue
        test = score >= bound if inclusive else score > bound
        chain = F.when(test, name) if chain is None else chain.when(test, name)
    return chain.otherwise(last)


def care_team(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(
        CARE_TEAM, "team_status string, allocated_doctor string, specialty string, contact string")


def allocate(df: DataFrame, status: str = "status", default: str = "LOW") -> DataFrame:
    """Add the care-team member of each row's status; an unknown status gets ``default``."""
    names = [r[0] for r in CARE_TEAM]
    wanted = F.upper(F.col(status))
    keyed = df.withColumn(
        "team_status", F.when(wanted.isin(*names), wanted).otherwise(F.lit(default)))
    # The team is a fixed three-row table.
    return keyed.join(F.broadcast(care_team(df)), "team_status", "left").drop("team_status")


def advise(df: DataFrame, column: str, texts: Sequence[tuple[str, str]], name: str) -> DataFrame:
    """Add the text belonging to a tier; ``texts`` is a fixed short table."""
    dim = df.sparkSession.createDataFrame(texts, f"{column} string, {name} string")
    return df.join(F.broadcast(dim), column, "left")


def topic(text: Column) -> Column:
    return first_match(text, TOPICS, NO_TOPIC)


def notice(name: Column, score: Column, status: Column, sender: str) -> Column:
    """Notification text of a scored row."""
    return F.format_string(NOTICE, name, F.lit(sender), status, score)


def model_inputs(df: DataFrame) -> DataFrame:
    """The 89 model columns of a scoring input, by rule or fixed default.

    An unknown insulin counts as none. Where another input is missing, columns that need it
    are NULL.
    """
    middle = mapped(F.col("age"), AGE_MIDDLE, 75).cast("double")
    stay = F.col("time_in_hospital").cast("double")
    labs = F.col("num_lab_procedures").cast("double")
    meds = F.col("num_medications").cast("double")
    ill = F.coalesce(F.col("has_comorbidity"), F.lit(False)).cast("int")
    treated = F.coalesce(F.col("on_medication"), F.lit(False)).cast("int")
    insulin = F.coalesce(F.col("insulin"), F.lit("No"))
    prior = F.col("number_inpatient") > 0
    per_day = F.lit(1.0) / F.greatest(F.lit(1.0), stay)
    # A scoring input above the last edge stays in the top class, unlike in training.
    stay_class = right_closed(stay, [-1e9, 3, 7, 14, 1e9], STAY_CODES)
    med_class = right_closed(meds, [-1e9, 5, 10, 1e9], MEDICATION_CODES)
    age_class = right_closed(middle, [-1e9] + AGE_EDGES[1:-1] + [1e9], AGE_CODES)
    fixed = INPUT_DEFAULTS | {d: 1 for d in DRUGS if d != "insulin"} | {d: 0 for d in DRUG_COMBINATIONS}
    made = {name: F.lit(float(v)) for name, v in fixed.items()}
    made |= {
        "gender": mapped(F.col("gender"), GENDER_CODE, 0),
        "age": mapped(F.col("age"), AGE_CODE, 7),
        "time_in_hospital": stay,
        "num_lab_procedures": labs,
        "num_medications": meds,
        "number_diagnoses": F.col("num_diagnoses"),
        "number_inpatient": F.col("number_inpatient"),
        "insulin": mapped(insulin, INSULIN_CODE, 1),
        "change": insulin.isin("No", "Steady").cast("int"),
        "diabetesMed": treated,
        "total_diagnoses_count": F.col("num_diagnoses"),
        "chronic_diagnosis_flag": ill,
        "has_diabetes": ill, "has_heart_disease": ill,
        "has_respiratory_disease": ill, "has_kidney_disease": ill,
        "chronic_disease_count": ill * 4,
        "comorbidity_index": ill * 6,
        "total_medications": meds,
        "medication_complexity_score": med_class,
        "insulin_usage": (insulin != "No").cast("int"),
        "diabetic_med_flag": treated,
        "medication_change_flag": insulin.isin("Up", "Down").cast("int"),
        "procedure_to_stay_ratio": per_day,
        "hospital_stay_category": stay_class,
        "length_of_stay_squared": stay * stay,
        "length_of_stay_log": F.log1p(stay),
        "average_daily_procedures": per_day,
        "time_in_hospital_category": stay_class,
        "readmission_history_flag": prior.cast("int"),
        "days_since_last_admission": F.when(prior, 30).otherwise(0),
        "age_midpoint": middle,
        "age_risk_group": age_class,
        "elderly_flag": (middle > 65).cast("int"),
        "very_elderly_flag": (middle > 75).cast("int"),
        "age_medication_interaction": middle * meds,
        "age_comorbidity_interaction": middle * ill * 4,
        "lab_test_frequency": labs,
        "age_length_stay": middle * stay,
        "diabetes_medication_combo": ill * treated,
        "procedures_medications": meds,
        "comorbidity_age": ill * 6 * age_class,
    }
    return df.select("encounter_id", "patient_name", *[
        c.cast("double").alias(name) for name, c in made.items()])


def with_model_score(
    df: DataFrame, probability: str = "probability", name: str = "risk_score"
) -> DataFrame:
    """Add the score in percent of a model probability, with the name offset."""
    pointed = df.withColumn(
        "_points", F.col(probability) * 100.0 + name_noise(F.col("patient_name")))
    return with_rounded_tenth(
        pointed, name, clamp(F.col("_points"), LOWEST, HIGHEST)).drop("_points")


def sample_feed(df: DataFrame, ages: Mapping[int, str]) -> DataFrame:
    """Display records from encoded rows, by a plain linear stand-in for the score."""
    risk = F.least(
        F.lit(98.5),
        15.0 + F.col("num_lab_procedures") / 2 + F.col("number_inpatient") * 10)
    return df.select(
        F.format_string("Sample Patient #%d", F.col("position") + 101).alias("patient_name"),
        F.format_string("+1-555-0%d", F.col("position") + 100).alias("phone"),
        mapped(F.col("age").cast("int"), ages, "Unknown").alias("age"),
        risk.alias("risk_score"),
        F.col("time_in_hospital").cast("int").alias("los"),
        tier(risk, POLICIES["sample"]).alias("status"),
    )
