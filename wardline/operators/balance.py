"""Class balancing by synthetic minority rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions.codes import order_hash, unit_interval
from wardline.operators.neighbours import nearest_neighbours
from wardline.operators.ordering import hash_cutoffs
from wardline.session import cut_lineage


def synthetic_minority(
    train: DataFrame, key: str, label: str, features: Sequence[str], k: int = 5,
    seed: int = 42, **search,
) -> DataFrame:
    """Rows on the segments between a minority row and one of its k neighbours.

    Made until both classes have the same size: every minority row gives an equal
    number, and the remainder goes to the first rows in hash order. A minority of one row
    has no neighbour and gives copies of it; rows without a label take no part. Columns: the
    seed row's key, ``copy`` (from 1), the features and the label.
    """
    sizes = {r[label]: r["n"] for r in
             train.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n")).collect()}
    minority = min(sizes, key=lambda c: (sizes[c], -c))
    held, need = sizes[minority], max(sizes.values()) - sizes[minority]
    rows = train.where(F.col(label) == minority).select(
        key, F.array(*[F.col(c).cast("double") for c in features]).alias("x"))
    each, rest = divmod(need, held)
    digest = order_hash(F.col(key), seed=seed)
    last = hash_cutoffs(
        rows.select(key, F.lit(0).alias("_g")), digest, ["_g"], {"_to": F.lit(rest)}
    ).first()["_to"]
    copies = F.lit(each) + F.when(digest <= F.lit(last), 1).otherwise(0)
    if held == 1:
        single = rows.withColumn("copy", F.explode(F.when(
            copies > 0, F.sequence(F.lit(1), copies)).otherwise(F.array().cast("array<int>"))))
        return single.select(
            key, "copy", *[F.col("x")[i].alias(c) for i, c in enumerate(features)],
            F.lit(minority).alias(label))
    draw = order_hash(F.col(key), F.col("copy"), seed=seed)
    neighbours = nearest_neighbours(rows, key, "x", min(k, held - 1), **search)
    within = F.conv(F.substring(draw, 9, 8), 16, 10).cast("bigint") % min(k, held - 1)
    seeds = (
        rows.withColumn("copy", F.explode(F.when(
            copies > 0, F.sequence(F.lit(1), copies)).otherwise(F.array().cast("array<int>"))))
        .withColumns({"position": within.cast("int"), "_u": unit_interval(draw)})
    )
    other = rows.select(F.col(key).alias("neighbour"), F.col("x").alias("_y"))
    # Sides with a row an encounter are not broadcast, however small their files are.
    placed = (
        seeds.join(neighbours.select(key, "position", "neighbour").hint("merge"), [key, "position"])
        .join(other.hint("merge"), "neighbour")
    )
    made = placed.withColumn(
        "_z", F.zip_with("x", "_y", lambda a, b: b - a))
    moved = made.select(
        key, "copy",
        F.zip_with("x", F.transform("_z", lambda d: d * F.col("_u")), lambda a, d: a + d)
        .alias("_new"))
    return moved.select(
        key, "copy", *[F.col("_new")[i].alias(c) for i, c in enumerate(features)],
        F.lit(minority).alias(label))


def balance(
    train: DataFrame, key: str, label: str, features: Sequence[str], k: int = 5,
    seed: int = 42, **search,
) -> DataFrame:
    """Original rows (``copy`` 0) and synthetic ones.

    The synthetic rows are written once, since every later pass of a model fit would
    otherwise search for neighbours again.
    """
    made = cut_lineage(synthetic_minority(train, key, label, features, k, seed, **search))
    original = train.select(
        key, F.lit(0).alias("copy"), *[F.col(c).cast("double").alias(c) for c in features], label)
    return original.unionByName(made)


def class_change(before: DataFrame, after: DataFrame, label: str) -> DataFrame:
    """(label, n_before, n_after, n_synthetic)."""
    old = before.groupBy(label).agg(F.count("*").alias("n_before"))
    new = after.groupBy(label).agg(F.count("*").alias("n_after"))
    return old.join(new, label, "outer").fillna(0).withColumn(
        "n_synthetic", F.col("n_after") - F.col("n_before"))
