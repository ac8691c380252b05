"""From featured rows to the encoded, split and scaled model table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.operators.clean import drop_if_present
from wardline.operators.encode import fit_scaler, label_encode, scale
from wardline.operators.split import stratified_split
from wardline.plans import stages
from wardline.session import staged
from wardline.sources.layout import KEY, LABEL_CODED, NOT_MODELLED, TARGET

# The columns that are scaled before modelling.
SCALED = [
    "time_in_hospital", "num_lab_procedures", "num_medications", "total_medications",
    "procedure_to_stay_ratio", "length_of_stay_squared", "length_of_stay_log",
    "average_daily_procedures", "age_medication_interaction",
    "age_comorbidity_interaction", "lab_test_frequency", "age_length_stay",
    "procedures_medications", "comorbidity_age",
]


def encode_rows(labelled: DataFrame) -> DataFrame:
    """Key, 89 numeric columns and the label; codes come from all labelled rows."""
    slim = drop_if_present(labelled, [*NOT_MODELLED, TARGET])
    return label_encode(slim, LABEL_CODED)


def model_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (KEY, "label", "split")]


def split_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Encoded rows with their split, before scaling."""
    def build():
        coded = encode_rows(stages.labelled(spark, folder))
        return staged(stratified_split(coded, KEY, "label"), "split", ("split",))

    return stages.once(spark, folder, "split", build)


def scaled_split(spark: SparkSession, folder: str):
    """Scaled rows of every split and the scaler learned from the training rows."""
    rows = split_rows(spark, folder)
    fitted = stages.once(
        spark, folder, "scaler",
        lambda: fit_scaler(rows.where(F.col("split") == "train"), SCALED))
    return scale(rows, fitted), fitted
