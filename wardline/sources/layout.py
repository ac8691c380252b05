"""Declared column lists and schema of the encounter table."""

from __future__ import annotations

from pyspark.sql import types as T

# The column lists and null tokens that define the encounter table.
KEY = "encounter_id"
PATIENT = "patient_nbr"
TARGET = "readmitted"

NUMERIC = [
    "time_in_hospital",
    "num_lab_procedures",
    "num_procedures",
    "num_medications",
    "number_outpatient",
    "number_emergency",
    "number_inpatient",
    "number_diagnoses",
]
CODED = ["admission_type_id", "discharge_disposition_id", "admission_source_id"]
DIAGNOSES = ["diag_1", "diag_2", "diag_3"]
LABS = ["max_glu_serum", "A1Cresult"]
DRUGS = [
    "metformin", "repaglinide", "nateglinide", "chlorpropamide", "glimepiride",
    "acetohexamide", "glipizide", "glyburide", "tolbutamide", "pioglitazone",
    "rosiglitazone", "acarbose", "miglitol", "troglitazone", "tolazamide",
    "examide", "citoglipton", "insulin",
]
DRUG_COMBINATIONS = [
    "glyburide_metformin", "glipizide_metformin", "glimepiride_pioglitazone",
    "metformin_rosiglitazone", "metformin_pioglitazone",
]
FLAGS = ["change", "diabetesMed"]
CATEGORICAL = (
    ["race", "gender", "age"] + CODED + ["payer_code", "medical_specialty"]
    + DIAGNOSES + LABS + DRUGS + DRUG_COMBINATIONS + FLAGS
)
# Free or sparse text columns that never reach the model.
NOT_MODELLED = [PATIENT] + DIAGNOSES + ["weight", "payer_code", "medical_specialty"]
LABEL_CODED = (
    ["race", "gender", "age"] + CODED + LABS + DRUGS + DRUG_COMBINATIONS + FLAGS
)
NULL_TOKENS = ("?", "Unknown", "", "None", "NA", "N/A", "NaN", "nan", "null", "NULL")
CLASSES = ["<30", ">30", "NO"]
# End of fixed values.

COLUMN_ORDER = (
    [KEY, PATIENT, "race", "gender", "age", "weight"] + CODED
    + ["time_in_hospital", "payer_code", "medical_specialty"]
    + ["num_lab_procedures", "num_procedures", "num_medications",
       "number_outpatient", "number_emergency", "number_inpatient"]
    + DIAGNOSES + ["number_diagnoses"] + LABS
    + [d for d in DRUGS if d not in ("examide", "citoglipton", "insulin")]
    + DRUG_COMBINATIONS + ["examide", "citoglipton", "insulin"] + FLAGS + [TARGET]
)


def encounter_schema() -> T.StructType:
    """Explicit schema of the raw encounter table; production reads never infer."""
    types = {KEY: T.LongType(), PATIENT: T.LongType()}
    types.update({c: T.IntegerType() for c in NUMERIC + CODED})
    return T.StructType(
        [T.StructField(c, types.get(c, T.StringType()), True) for c in COLUMN_ORDER]
    )
