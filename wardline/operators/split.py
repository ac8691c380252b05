"""Exact stratified split, split summary and leakage checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions.codes import order_hash
from wardline.functions.stats import percent
from wardline.operators.ordering import hash_cutoffs, with_small_side
from wardline.operators.reshape import aggregates

# Shares of the split in percent, and its seed.
TRAIN, VALIDATION, TEST = 70, 15, 15
SEED = 42


def stratified_split(
    df: DataFrame, key: str, label: str, train: int = TRAIN, validation: int = VALIDATION,
    seed: int = SEED,
) -> DataFrame:
    """Add ``split``: within each class exactly the floor of each share, by row hash.

    Only keys and labels are scanned to find two boundary hashes per class; labelling
    the rows is then a comparison per row, so the wide table is never shuffled and a
    class holding most rows costs nothing extra. A row without a label stays and has no
    split.
    """
    digest = order_hash(F.col(key), seed=seed)
    n = F.col("n")
    cutoffs = hash_cutoffs(
        df.where(F.col(label).isNotNull()).select(key, label), digest, [label],
        {
            "_train_to": F.floor(n * train / 100),
            "_val_to": F.floor(n * (train + validation) / 100),
        },
    ).drop("n")
    placed = with_small_side(df, cutoffs, [label], "left")
    split = (
        F.when(F.col(label).isNull(), None).when(digest <= F.col("_train_to"), "train")
        .when(digest <= F.col("_val_to"), "val").otherwise("test")
    )
    return placed.withColumn("split", split).drop("_train_to", "_val_to")


def split_summary(df: DataFrame, label: str) -> DataFrame:
    """(split, n_samples, pct_total, n_readmitted, n_not_readmitted, readmission_rate)."""
    total = df.agg(F.count("*")).scalar()
    return df.groupBy("split").agg(
        F.count("*").alias("n_samples"),
        F.count_if(F.col(label) == 1).alias("n_readmitted"),
        F.count_if(F.col(label) == 0).alias("n_not_readmitted"),
        F.round(F.avg(label) * 100, 2).alias("readmission_rate"),
    ).withColumn("pct_total", percent(F.col("n_samples"), total, 2))


def rate_spread(df: DataFrame, label: str, tolerance: float = 0.01) -> DataFrame:
    rates = df.groupBy("split").agg(F.avg(label).alias("rate"))
    return rates.agg((F.max("rate") - F.min("rate")).alias("spread")).withColumn(
        "status", F.when(F.col("spread") < tolerance, "PASS").otherwise("FAIL"))


def shared_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys found in more than one split, for every pair of splits, in one pass."""
    per_key = df.groupBy(key).agg(
        *[F.max((F.col("split") == s).cast("int")).alias(s) for s in ("train", "val", "test")])
    pairs = (("train", "val"), ("train", "test"), ("val", "test"))
    return per_key.agg(*[
        F.count_if((F.col(a) == 1) & (F.col(b) == 1)).alias(f"{a}_{b}") for a, b in pairs])


def leakage_checks(
    df: DataFrame, key: str, label: str, scaler: Mapping[str, tuple[float, float]],
    columns: Sequence[str], tolerance: float = 0.01,
) -> DataFrame:
    """(check, status) over the unscaled, split rows.

    The scaler check derives mean and deviation again from the training rows.
    """
    overlap = shared_keys(df, key).select(
        F.lit("Index overlap check").alias("check"),
        F.when(F.col("train_val") + F.col("train_test") + F.col("val_test") == 0, "PASS")
        .otherwise("FAIL").alias("status"))
    again = df.where(F.col("split") == "train").agg(
        *aggregates(columns, mean=F.avg, std=F.stddev_pop))
    agree = F.lit(True)
    for c in columns:
        mean, std = scaler[c]
        fresh = F.when(F.col(f"`{c}|std`") == 0, 1.0).otherwise(F.col(f"`{c}|std`"))
        agree = agree & (F.abs(F.col(f"`{c}|mean`") - mean) <= 1e-9 * (1 + abs(mean)))
        agree = agree & (F.abs(fresh - std) <= 1e-9 * (1 + abs(std)))
    scaled = again.select(
        F.lit("Scaler fit on train only").alias("check"),
        F.when(agree, "PASS").otherwise("FAIL").alias("status"))
    strata = rate_spread(df, label, tolerance).select(
        F.lit("Stratification check").alias("check"), "status")
    return overlap.unionByName(scaled).unionByName(strata)
