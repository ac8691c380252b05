"""Exploratory aggregates: shares, rates, cross-tabs, histograms, boxes, correlations."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.stats import pearson, percent, ratio
from wardline.operators.ordering import null_safe_join, with_small_side
from wardline.operators.quantiles import grouped_quantiles
from wardline.operators.reshape import aggregates, row_per_column, value_counts


def class_shares(df: DataFrame, column: str) -> DataFrame:
    """(column, n, pct) per value."""
    total = df.agg(F.count("*")).scalar()
    return df.groupBy(column).agg(F.count("*").alias("n")).withColumn(
        "pct", percent(F.col("n"), total, 2)
    )


def imbalance(df: DataFrame, column: str) -> DataFrame:
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.agg(
        F.max("n").alias("largest"), F.min("n").alias("smallest"),
        ratio(F.max("n"), F.min("n")).alias("imbalance_ratio"),
    )


def returned(target: Column) -> Column:
    """Whether the patient came back at all; an unknown outcome counts as a return."""
    return F.coalesce(target != "NO", F.lit(True))


def rate_by(df: DataFrame, group: str, hit: Column, name: str = "rate") -> DataFrame:
    """(group, n, rate in percent)."""
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(
        F.count("*").alias("n"),
        F.avg(F.when(hit, F.lit(100.0)).otherwise(F.lit(0.0))).alias(name),
    )


def cross_tab(df: DataFrame, rows: str, columns: str, values: Sequence) -> DataFrame:
    """Zero-filled counts, one column per listed value."""
    counted = df.groupBy(rows).agg(*[
        F.count_if(F.col(columns) == v).alias(str(v)) for v in values
    ])
    return counted


def class_stats(df: DataFrame, columns: Sequence[str], group: str, **limits) -> DataFrame:
    """(column, group, mean, median, std, min, max) of every column in each class, NULL being one."""
    fields = {f: "double" for f in ("mean", "std", "min", "max")}
    wide = df.groupBy(group).agg(*aggregates(
        columns, mean=F.avg, std=F.stddev_samp, min=F.min, max=F.max))
    middle = grouped_quantiles(df, [group], columns, [0.5], **limits).select(
        group, "column", F.col("q")[0].alias("median"))
    return null_safe_join(row_per_column(wide, columns, fields, [group]), middle, [group, "column"], "left")


def part_stats(df: DataFrame, columns: Sequence[str], part: str) -> DataFrame:
    """(part, column, mean, std, min, p25, p50, p75, max)."""
    fields = {f: "double" for f in ("mean", "std", "min", "max")}
    wide = df.groupBy(part).agg(*aggregates(
        columns, mean=F.avg, std=F.stddev_samp, min=F.min, max=F.max))
    quartiles = grouped_quantiles(df, [part], columns, [0.25, 0.5, 0.75]).select(
        part, "column", F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"),
        F.col("q")[2].alias("p75"))
    return null_safe_join(row_per_column(wide, columns, fields, [part]), quartiles, [part, "column"], "left")


def histogram(df: DataFrame, columns: Sequence[str], bins: int, group: str | None = None
              ) -> DataFrame:
    """Equal-width counts over each column's own range, empty bins included.

    Rows are binned where they are read and only bin counts are shuffled. The top bin
    is closed. With ``group`` every class uses its own range. A constant
    column gets a range of one unit around its value.
    """
    by = [group] if group else []
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
        for c in columns
    ])
    wide = df.groupBy(*by).agg(*aggregates(columns, lo=F.min, hi=F.max))
    flat = F.col("lo") == F.col("hi")
    ranges = row_per_column(wide, columns, {"lo": "double", "hi": "double"}, by).select(
        *by, "column",
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    ).where("lo is not null")
    values = (
        df.select(*by, F.explode(pairs).alias("_e")).where("_e.value is not null")
        .select(*by, "_e.*")
    )
    width = (F.col("hi") - F.col("lo")) / bins
    binned = (
        with_small_side(values, ranges, by + ["column"], "inner")
        .withColumn("bin", F.least(
            F.floor((F.col("value") - F.col("lo")) / width), F.lit(bins - 1)).cast("int"))
        .groupBy(*by, "column", "bin").agg(F.count("*").alias("n"))
    )
    slots = ranges.select(
        *by, "column", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
        "lo", width.alias("_w"),
    ).select(
        *by, "column", "bin",
        (F.col("lo") + F.col("bin") * F.col("_w")).alias("left_edge"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("_w")).alias("right_edge"),
    )
    return null_safe_join(slots, binned, by + ["column", "bin"], "left").fillna(0, ["n"])


def box_stats(df: DataFrame, column: str, group: str, whisker: float = 1.5, **limits) -> DataFrame:
    """Five-number summary per class, whiskers at the last values inside the fences."""
    q = grouped_quantiles(df, [group], [column], [0.25, 0.5, 0.75], **limits).select(
        group, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"),
        F.col("q")[2].alias("q3"))
    spread = whisker * (F.col("q3") - F.col("q1"))
    value = F.col(column)
    within = (value >= F.col("q1") - spread) & (value <= F.col("q3") + spread)
    return (
        with_small_side(df.select(group, column), q, [group], "inner")
        .groupBy(group, "q1", "median", "q3")
        .agg(
            F.min(F.when(within, value)).alias("whisker_low"),
            F.max(F.when(within, value)).alias("whisker_high"),
            F.count_if(~within).alias("fliers"),
        )
    )


def _correlations(
    df: DataFrame, columns: Sequence[str], pairs: Sequence[tuple[str, str]]
) -> dict[tuple[str, str], float | None]:
    """Correlation of each pair; NULL when either side is constant.

    Columns without gaps share one matrix pass. A pair with gaps uses the rows where
    both sides are known, in one aggregate over all such pairs.
    """
    gaps = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    whole = [c for c in columns if gaps[c] == 0]
    out: dict[tuple[str, str], float | None] = {}
    if len(whole) > 1:
        vectors = VectorAssembler(inputCols=whole, outputCol="v").transform(
            df.select(*[F.col(c).cast("double").alias(c) for c in whole]))
        matrix = Correlation.corr(vectors, "v").first()[0].toArray()
        place = {c: i for i, c in enumerate(whole)}
        for x, y in pairs:
            if x in place and y in place:
                r = float(matrix[place[x], place[y]])
                # A constant column has no correlation, not even with itself.
                out[x, y] = None if math.isnan(r) else r
        constant = {
            c for c in whole
            if all(math.isnan(matrix[place[c], place[o]]) for o in whole if o != c)
        }
        out.update({(c, c): None for c in constant if (c, c) in out})
    left = [p for p in pairs if p not in out]
    if left:
        row = df.agg(*[
            pearson(F.col(x), F.col(y)).alias(f"r{i}") for i, (x, y) in enumerate(left)]).first()
        out.update({p: row[f"r{i}"] for i, p in enumerate(left)})
    return out


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x, y, r) for every ordered pair; one row per pair of columns."""
    found = _correlations(df, columns, list(combinations_with_replacement(columns, 2)))
    rows = []
    for (x, y), r in found.items():
        rows += [(a, b, r) for a, b in sorted({(x, y), (y, x)})]
    return df.sparkSession.createDataFrame(rows, "x string, y string, r double")


def target_correlations(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """(column, r) against one target column, undefined ones kept as NULL."""
    found = _correlations(df, [*columns, target], [(c, target) for c in columns])
    return df.sparkSession.createDataFrame(
        [(c, found[c, target]) for c in columns], "column string, r double")


def strongest(correlations: DataFrame, k: int) -> DataFrame:
    """The ``k`` largest by absolute value, undefined ones left out."""
    return (
        correlations.where("r is not null").withColumn("abs_r", F.abs("r"))
        .orderBy(F.desc("abs_r"), "column").limit(k)
    )


def value_shares(df: DataFrame, columns: Sequence[str], most: int = 20) -> DataFrame:
    """Share of each value, for columns with at most ``most`` distinct values."""
    counts = value_counts(df, columns).where("value is not null")
    sizes = counts.groupBy("column").agg(
        F.sum("n").alias("_total"), F.count("*").alias("_distinct")
    ).where(F.col("_distinct") <= most)
    return with_small_side(counts, sizes, ["column"], "inner").select(
        "column", "value", "n", ratio(F.col("n"), F.col("_total")).alias("share")
    )


def ordered_counts(df: DataFrame, column: str, domain: Sequence[str]) -> DataFrame:
    """Counts in the order of ``domain``, zero where a listed value is absent."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    places = df.sparkSession.createDataFrame(
        [(i, v) for i, v in enumerate(domain)], "position int, value string")
    return places.join(counts, "value", "left").fillna(0, ["n"]).select("position", "value", "n")


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The ``k`` most frequent values, smaller value first on ties."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), column).limit(k)
