"""From one wide row of statistics to one row per column, and value counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_per_column(
    wide: DataFrame, columns: Sequence[str], fields: Mapping[str, str],
    by: Sequence[str] = (), name: str = "column",
) -> DataFrame:
    """Turn ``<column>|<field>`` aggregates into rows (by..., name, fields...).

    ``fields`` maps an output name to its type.
    """
    entries = F.array(*[
        F.struct(
            F.lit(c).alias(name),
            *[F.col(f"`{c}|{f}`").cast(t).alias(f) for f, t in fields.items()],
        )
        for c in columns
    ])
    return wide.select(*by, F.explode(entries).alias("_e")).select(*by, "_e.*")


def aggregates(
    columns: Sequence[str], **stats
) -> list[Column]:
    """``stats`` maps a field to a function from column expression to aggregate."""
    return [
        build(F.col(f"`{c}`")).alias(f"{c}|{field}")
        for c in columns for field, build in stats.items()
    ]


def value_counts(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), kind: str = "string"
) -> DataFrame:
    """(by..., column, value, n) for every column in one pass, NULL counted as a value.

    Counts are combined before the shuffle, so a value held by most rows costs one
    row per task.
    """
    entries = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast(kind).alias("value"))
        for c in columns
    ])
    return (
        df.select(*by, F.explode(entries).alias("_e"))
        .groupBy(*by, "_e.column", "_e.value")
        .agg(F.count("*").alias("n"))
    )
