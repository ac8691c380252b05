"""Engineered columns: one projection of native expressions per group, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions.codes import band_midpoint, icd_number, mapped
from wardline.functions.stats import any_of, flag, right_closed
from wardline.sources.layout import DIAGNOSES

# Code ranges, weights, interval edges and code maps of the features.
CHRONIC_RANGES = {
    "has_diabetes": (250, 250),
    "has_heart_disease": (390, 429),
    "has_respiratory_disease": (460, 519),
    "has_kidney_disease": (580, 629),
}
CHRONIC_WEIGHTS = {
    "has_diabetes": 1, "has_heart_disease": 2,
    "has_respiratory_disease": 1, "has_kidney_disease": 2,
}
MEDICATION_EDGES, MEDICATION_CODES = [-1, 5, 10, 999], [1, 2, 3]
PROCEDURE_EDGES, PROCEDURE_CODES = [-1, 0, 2, 5, 999], [0, 1, 2, 3]
STAY_EDGES, STAY_CODES = [0, 3, 7, 14, 999], [0, 1, 2, 3]
AGE_EDGES, AGE_CODES = [-1, 40, 60, 75, 999], [0, 1, 2, 3]
ADMISSION_TYPE_RISK = {1: 3, 2: 2, 3: 1}
ADMISSION_SOURCE_RISK = {7: 3, 1: 2, 2: 2}
DISCHARGE_RISK = {1: 1, 3: 2, 5: 2, 6: 2, 7: 3}
GLUCOSE_LEVEL = {"None": 0, "Norm": 1, ">200": 2, ">300": 3}
A1C_LEVEL = {"None": 0, "Norm": 1, ">7": 2, ">8": 3}
GLUCOSE_BANDS = [(100, "NORMAL"), (126, "PREDIABETES")]
GLUCOSE_TOP = "DIABETES RANGE"
ENGINEERED = [
    "total_diagnoses_count", "has_primary_diagnosis", "diagnosis_diversity",
    "chronic_diagnosis_flag", "has_diabetes", "has_heart_disease",
    "has_respiratory_disease", "has_kidney_disease", "chronic_disease_count",
    "comorbidity_index", "total_medications", "medication_complexity_score",
    "insulin_usage", "diabetic_med_flag", "medication_change_flag", "total_procedures",
    "procedure_complexity_score", "has_surgery", "procedure_to_stay_ratio",
    "hospital_stay_category", "length_of_stay_squared", "length_of_stay_log",
    "average_daily_procedures", "time_in_hospital_category", "readmission_history_flag",
    "emergency_admission_flag", "admission_type_risk_score", "admission_source_risk",
    "days_since_last_admission", "age_midpoint", "age_risk_group", "elderly_flag",
    "very_elderly_flag", "age_medication_interaction", "age_comorbidity_interaction",
    "lab_test_frequency", "glucose_level_category", "A1C_result_category",
    "abnormal_lab_count", "discharge_to_home_flag", "discharge_with_services_flag",
    "ama_discharge_flag", "discharge_disposition_risk", "age_length_stay",
    "diabetes_medication_combo", "procedures_medications", "comorbidity_age",
    "emergency_elderly",
]
# End of fixed values.


def _zero(name: str):
    return F.coalesce(F.col(name), F.lit(0))


def diagnosis_features(df: DataFrame) -> DataFrame:
    """Counts over the three diagnosis codes and one flag per chronic range."""
    codes = F.array_compact(F.array(*[F.col(c) for c in DIAGNOSES]))
    # Each code is parsed once; the range tests then compare numbers.
    parsed = df.withColumns({f"_{c}": icd_number(F.col(c)) for c in DIAGNOSES})
    flags = {
        name: flag(any_of([F.col(f"_{c}").between(*bounds) for c in DIAGNOSES]))
        for name, bounds in CHRONIC_RANGES.items()
    }
    counted = parsed.withColumns({
        "total_diagnoses_count": F.size(codes),
        "has_primary_diagnosis": F.col(DIAGNOSES[0]).isNotNull().cast("int"),
        "diagnosis_diversity": F.size(F.array_distinct(codes)),
        **flags,
    }).drop(*[f"_{c}" for c in DIAGNOSES])
    total = sum((F.col(n) for n in CHRONIC_RANGES), F.lit(0))
    weighted = sum((F.col(n) * w for n, w in CHRONIC_WEIGHTS.items()), F.lit(0))
    return counted.withColumns({
        "chronic_diagnosis_flag": (total > 0).cast("int"),
        "chronic_disease_count": total,
        "comorbidity_index": weighted,
    })


def medication_features(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "total_medications": F.col("num_medications"),
        "medication_complexity_score": right_closed(
            F.col("num_medications"), MEDICATION_EDGES, MEDICATION_CODES),
        "insulin_usage": flag(F.lower("insulin") != "no", unknown=True),
        "diabetic_med_flag": flag(F.lower("diabetesMed") == "yes"),
        "medication_change_flag": flag(F.lower("change") == "ch"),
    })


def _per_day():
    days = F.when(F.col("time_in_hospital") == 0, 1).otherwise(F.col("time_in_hospital"))
    return F.col("num_procedures").cast("double") / days


def procedure_features(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "total_procedures": F.col("num_procedures"),
        "procedure_complexity_score": right_closed(
            F.col("num_procedures"), PROCEDURE_EDGES, PROCEDURE_CODES),
        "has_surgery": flag(F.col("num_procedures") > 0),
        "procedure_to_stay_ratio": _per_day(),
    })


def stay_features(df: DataFrame) -> DataFrame:
    days = F.col("time_in_hospital")
    category = right_closed(days, STAY_EDGES, STAY_CODES)
    return df.withColumns({
        "hospital_stay_category": category,
        "length_of_stay_squared": days * days,
        "length_of_stay_log": F.log1p(days),
        "average_daily_procedures": _per_day(),
        "time_in_hospital_category": category,
    })


def admission_features(df: DataFrame) -> DataFrame:
    admission = F.col("admission_type_id").try_cast("int")
    source = F.col("admission_source_id").try_cast("int")
    return df.withColumns({
        "readmission_history_flag": flag(F.col("number_inpatient") > 0),
        "emergency_admission_flag": flag(F.col("number_emergency") > 0),
        "admission_type_risk_score": mapped(admission, ADMISSION_TYPE_RISK, 1),
        "admission_source_risk": mapped(source, ADMISSION_SOURCE_RISK, 1),
        "days_since_last_admission": F.when(F.col("number_inpatient") == 0, 0).otherwise(30),
    })


def age_features(df: DataFrame) -> DataFrame:
    aged = df.withColumn("age_midpoint", band_midpoint(F.col("age")))
    middle = F.col("age_midpoint")
    return aged.withColumns({
        "age_risk_group": right_closed(middle, AGE_EDGES, AGE_CODES),
        "elderly_flag": flag(middle > 65),
        "very_elderly_flag": flag(middle > 75),
        "age_medication_interaction": _zero("age_midpoint") * _zero("num_medications"),
        "age_comorbidity_interaction": _zero("age_midpoint") * _zero("chronic_disease_count"),
    })


def lab_features(df: DataFrame) -> DataFrame:
    glucose = mapped(F.col("max_glu_serum"), GLUCOSE_LEVEL, 0)
    a1c = mapped(F.col("A1Cresult"), A1C_LEVEL, 0)
    return df.withColumns({
        "lab_test_frequency": F.col("num_lab_procedures"),
        "glucose_level_category": glucose,
        "A1C_result_category": a1c,
        "abnormal_lab_count": (glucose > 1).cast("int") + (a1c > 1).cast("int"),
    })


def discharge_features(df: DataFrame) -> DataFrame:
    where_to = F.col("discharge_disposition_id").try_cast("int")
    return df.withColumns({
        "discharge_to_home_flag": flag(where_to == 1),
        "discharge_with_services_flag": flag(where_to == 6),
        "ama_discharge_flag": flag(where_to == 7),
        "discharge_disposition_risk": mapped(where_to, DISCHARGE_RISK, 1),
    })


def interaction_features(df: DataFrame) -> DataFrame:
    """Products of columns made by the other groups."""
    return df.withColumns({
        "age_length_stay": _zero("age_midpoint") * _zero("time_in_hospital"),
        "diabetes_medication_combo": F.col("has_diabetes") * F.col("diabetic_med_flag"),
        "procedures_medications": F.col("total_procedures") * F.col("total_medications"),
        "comorbidity_age": F.col("comorbidity_index") * _zero("age_risk_group"),
        "emergency_elderly": F.col("emergency_admission_flag") * F.col("elderly_flag"),
    })


def engineer(df: DataFrame) -> DataFrame:
    """All engineered columns, in their declared order, after the input columns."""
    made = df
    for step in (
        diagnosis_features, medication_features, procedure_features, stay_features,
        admission_features, age_features, lab_features, discharge_features,
        interaction_features,
    ):
        made = step(made)
    return made.select(*[f"`{c}`" for c in df.columns], *ENGINEERED)


def glucose_category(fasting):
    """Screening band of a fasting glucose value."""
    chain = None
    for below, name in GLUCOSE_BANDS:
        test = fasting < below
        chain = F.when(test, name) if chain is None else chain.when(test, name)
    return chain.when(fasting.isNotNull(), GLUCOSE_TOP)
