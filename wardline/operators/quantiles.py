"""Linearly interpolated quantiles, exact at any size."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.operators.ordering import (
    ONE_TASK_ROWS,
    order_statistics,
    running_sums,
    null_safe_join,
    with_small_side,
)
from wardline.session import cut_lineage

# The built-in aggregate keeps one counter per distinct value and group.
DISTINCT_LIMIT = 200_000


def narrow_and_wide(
    df: DataFrame, columns: Sequence[str], limit: int = DISTINCT_LIMIT
) -> tuple[list[str], list[str]]:
    """Columns whose distinct values fit one aggregation buffer, and the others."""
    if not columns:
        return [], []
    sizes = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    return (
        [c for c in columns if sizes[c] <= limit],
        [c for c in columns if sizes[c] > limit],
    )


def column_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float],
    limit: int = DISTINCT_LIMIT, one_task_rows: int = ONE_TASK_ROWS,
) -> dict[str, list[float | None]]:
    """Quantiles of whole columns, as a small driver-side parameter set."""
    columns = list(columns)
    narrow, wide = narrow_and_wide(df, columns, limit)
    out: dict[str, list[float | None]] = {}
    if narrow:
        row = df.agg(
            *[F.percentile(c, F.array(*map(F.lit, probs))).alias(c) for c in narrow]
        ).first()
        out.update({c: row[c] if row[c] is not None else [None] * len(probs) for c in narrow})
    if wide:
        sizes = df.agg(*[F.count(c).alias(c) for c in wide]).first()
        targets = {}
        for c in wide:
            for p in probs:
                at = p * (sizes[c] - 1)
                for k in {math.floor(at), math.ceil(at)}:
                    targets[f"{c}#{k}"] = (F.col(c), k)
        picked = order_statistics(df, targets, one_task_rows)
        for c in wide:
            values = []
            for p in probs:
                at = p * (sizes[c] - 1)
                lo, hi = math.floor(at), math.ceil(at)
                a, b = float(picked[f"{c}#{lo}"]), float(picked[f"{c}#{hi}"])
                values.append(a if lo == hi else (hi - at) * a + (at - lo) * b)
            out[c] = values
    return out


def grouped_quantiles(
    df: DataFrame, by: Sequence[str], columns: Sequence[str], probs: Sequence[float],
    limit: int = DISTINCT_LIMIT, one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """(by..., column, q) with ``q`` the array of quantiles, per group and column.

    Columns with few distinct values use the built-in aggregate. For the others the
    distinct values are counted first, then ranked by running sums that spread one
    group over many tasks. Either way a NULL group is a group, and a group without values
    has a NULL ``q``.
    """
    by, columns = list(by), list(columns)
    narrow, wide = narrow_and_wide(df, columns, limit)
    grid = F.array(*map(F.lit, probs))
    parts = []
    if narrow:
        stats = df.groupBy(*by).agg(*[F.percentile(c, grid).alias(c) for c in narrow])
        entries = F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).alias("q")) for c in narrow
        ])
        parts.append(stats.select(*by, F.explode(entries).alias("_e")).select(*by, "_e.*"))
    if wide:
        entries = F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
            for c in wide
        ])
        # Counted, ranked and totalled below; written once so the scan is not repeated.
        counted = cut_lineage(
            df.select(*by, F.explode(entries).alias("_e"))
            .where("_e.value is not null")
            .groupBy(*by, "_e.column", "_e.value").agg(F.count("*").alias("n"))
        )
        keys = by + ["column"]
        ranked = running_sums(counted, ["value"], ["n"], keys, one_task_rows=one_task_rows)
        totals = counted.groupBy(*keys).agg(F.sum("n").alias("_total"))
        spots = totals.select(
            *keys,
            F.posexplode(F.transform(grid, lambda p: p * (F.col("_total") - 1)))
            .alias("_i", "_at"),
        ).select(*keys, "_i", "_at",
                 F.explode(F.array(F.floor("_at"), F.ceil("_at"))).alias("_rank")).distinct()
        # A spot falls in the run of equal values that covers its rank.
        spots = spots.groupBy(*keys).agg(
            F.collect_list(F.struct("_i", "_at", "_rank")).alias("_spots")
        )
        covered = with_small_side(ranked, spots, keys, "inner").select(
            *keys, "value",
            F.explode(F.filter(
                "_spots",
                lambda s: (s["_rank"] < F.col("cum_n"))
                & (s["_rank"] >= F.col("cum_n") - F.col("n")),
            )).alias("s"),
        )
        weighted = covered.groupBy(*keys, "s._i", "s._at").agg(
            F.sum(
                F.when(F.ceil("s._at") == F.floor("s._at"), F.col("value"))
                .when(F.col("s._rank") == F.floor("s._at"),
                      (F.ceil("s._at") - F.col("s._at")) * F.col("value"))
                .otherwise((F.col("s._at") - F.floor("s._at")) * F.col("value"))
            ).alias("_q")
        )
        found = weighted.groupBy(*keys).agg(
            F.transform(F.sort_array(F.collect_list(F.struct("_i", "_q"))),
                        lambda s: s["_q"]).alias("q"))
        # Groups without any value have no quantiles, but are groups.
        groups = df.select(*by).distinct().withColumn(
            "column", F.explode(F.array(*[F.lit(c) for c in wide])))
        parts.append(null_safe_join(groups, found, keys, "left").select(*keys, "q"))
    out = parts[0]
    for extra in parts[1:]:
        out = out.unionByName(extra)
    return out
