"""Profiles of a table: shape, gaps, duplicates, descriptions, distinct counts.

Every profile is one or two aggregations over all columns at once, turned into one
row per column afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.functions.codes import order_hash
from wardline.functions.stats import percent
from wardline.operators.clean import columns_of_kind
from wardline.operators.explore import target_correlations
from wardline.operators.quantiles import grouped_quantiles
from wardline.operators.reshape import aggregates, row_per_column, value_counts


def table_profile(df: DataFrame) -> DataFrame:
    """(column, dtype, position, row_count, column_count)."""
    entries = F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(t).alias("dtype"), F.lit(i).alias("position"))
        for i, (c, t) in enumerate(df.dtypes)
    ])
    return (
        df.agg(F.count("*").alias("row_count"))
        .select(F.explode(entries).alias("_e"), "row_count")
        .select("_e.*", "row_count", F.lit(len(df.columns)).alias("column_count"))
    )


def columns_per_type(df: DataFrame) -> DataFrame:
    return table_profile(df).groupBy("dtype").agg(F.count("*").alias("n_columns"))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, missing_count, missing_pct), in one pass."""
    columns = list(columns or df.columns)
    counted = df.agg(
        F.count("*").alias("_rows"),
        *[(F.count("*") - F.count(f"`{c}`")).alias(f"{c}|missing_count") for c in columns],
    )
    return row_per_column(
        counted, columns, {"missing_count": "bigint"}, by=["_rows"]
    ).select(
        "column", "missing_count",
        F.coalesce(percent(F.col("missing_count"), F.col("_rows"), 2), F.lit(0.0))
        .alias("missing_pct"),
    )


def top_gaps(df: DataFrame, k: int = 20) -> DataFrame:
    return (
        null_profile(df).where("missing_count > 0")
        .orderBy(F.desc("missing_pct"), "column").limit(k)
    )


def null_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """(column, before, after) of the columns that had gaps."""
    old = null_profile(before).select("column", F.col("missing_count").alias("before"))
    new = null_profile(after).select("column", F.col("missing_count").alias("after"))
    return old.where("before > 0").join(new, "column", "left")


def null_mask(df: DataFrame, key: str, columns: Sequence[str], rows: int = 500,
              seed: int = 42) -> DataFrame:
    """0/1 gap flags for a seeded sample of ``rows`` rows."""
    return sample_rows(df, key, rows, seed).select(
        key, *[F.col(c).isNull().cast("int").alias(c) for c in columns]
    )


def sample_rows(df: DataFrame, key: str, rows: int, seed: int = 42) -> DataFrame:
    """Exactly ``min(rows, N)`` rows, the same ones on every engine and partitioning."""
    return df.orderBy(order_hash(F.col(key), seed=seed)).limit(rows)


def duplicate_count(df: DataFrame) -> DataFrame:
    """Surplus copies of fully identical rows."""
    grouped = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count("*").alias("_n"))
    return grouped.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False,
                    by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, n_distinct); exact counts go through value counts, so no
    column's values are gathered in one place."""
    if approximate:
        wide = df.groupBy(*by).agg(*[
            F.approx_count_distinct(c).alias(f"{c}|n_distinct") for c in columns
        ])
        return row_per_column(wide, columns, {"n_distinct": "bigint"}, by)
    # Numbers are compared as numbers; those a double cannot hold exactly stay text.
    types = dict(df.dtypes)
    numbers = [c for c in columns if types[c] in ("tinyint", "smallint", "int", "float", "double")]
    texts = [c for c in columns if c not in numbers]
    counted = [
        value_counts(df, group, by, kind).groupBy(*by, "column")
        .agg(F.count("value").alias("n_distinct"))
        for group, kind in ((numbers, "double"), (texts, "string")) if group
    ]
    return counted[0] if len(counted) == 1 else counted[0].unionByName(counted[1])


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, unique, top and freq of text; moments and quartiles of numbers."""
    numbers = [c for c in columns_of_kind(df, True) if c in columns]
    texts = [c for c in columns if c not in numbers]
    parts = []
    if texts:
        known = value_counts(df, texts).where("value is not null")
        parts.append(known.groupBy("column").agg(
            F.sum("n").alias("count"),
            F.count("*").alias("unique"),
            F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
            F.max("n").alias("freq"),
        ))
    if numbers:
        fields = {f: "double" for f in ("mean", "std", "min", "max")} | {"count": "bigint"}
        wide = df.agg(*aggregates(
            numbers, count=F.count, mean=F.avg, std=F.stddev_samp, min=F.min, max=F.max))
        quartiles = grouped_quantiles(df.withColumn("_all", F.lit(1)), ["_all"], numbers,
                                      [0.25, 0.5, 0.75]).select(
            "column", F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"),
            F.col("q")[2].alias("p75"))
        parts.append(row_per_column(wide, numbers, fields).join(quartiles, "column", "left"))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def quality_score(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows removed, gaps before and after, and the share of filled cells in percent."""
    def sizes(df: DataFrame, stage: str) -> DataFrame:
        return df.agg(
            F.count("*").alias("rows"), sum_of_nulls(df.columns).alias("nulls")
        ).withColumn("stage", F.lit(stage))

    def of(stage: str, field: str) -> Column:
        return F.max(F.when(F.col("stage") == stage, F.col(field)))

    cells = F.greatest(F.col("rows_after") * len(after.columns), F.lit(1))
    return (
        sizes(before, "before").unionByName(sizes(after, "after"))
        .agg(
            of("before", "rows").alias("rows_before"), of("after", "rows").alias("rows_after"),
            of("before", "nulls").alias("nulls_before"),
            of("after", "nulls").alias("nulls_after"),
        )
        .select(
            "rows_before", "rows_after",
            (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"),
            "nulls_before", "nulls_after",
            F.round((1 - F.col("nulls_after") / cells) * 100, 2).alias("quality_score"),
        )
    )


def sum_of_nulls(columns: Sequence[str]) -> Column:
    per_row = sum((F.col(f"`{c}`").isNull().cast("int") for c in columns), F.lit(0))
    return F.coalesce(F.sum(per_row), F.lit(0))


def null_check(df: DataFrame, by: str) -> DataFrame:
    """(by, n_rows, n_null, status) over all columns of each part."""
    columns = [c for c in df.columns if c != by]
    counted = df.groupBy(by).agg(F.count("*").alias("n_rows"), sum_of_nulls(columns).alias("n_null"))
    return counted.withColumn("status", F.when(F.col("n_null") == 0, "OK").otherwise("WARN"))


def feature_validation(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Gaps, distinct values, moments, target correlation and kind of each feature.

    One wide aggregate for the moments, one value count for the distinct values.
    """
    fields = {"missing_pct": "double", "mean": "double", "std": "double"}
    wide = df.agg(*aggregates(
        features,
        missing_pct=lambda c: F.round(F.avg(c.isNull().cast("int")) * 100, 2),
        mean=lambda c: F.avg(c.cast("double")),
        std=lambda c: F.stddev_samp(c.cast("double")),
    ))
    kinds = dict(df.dtypes)
    types = F.create_map(*[F.lit(x) for c in features for x in (c, kinds[c])])
    distinct = distinct_counts(df, features).select(
        F.col("column").alias("feature"), F.col("n_distinct").alias("unique_values"))
    related = target_correlations(df, features, target).select(
        F.col("column").alias("feature"), F.col("r").alias("corr_target"))
    return (
        row_per_column(wide, features, fields, name="feature")
        .join(distinct, "feature", "left").join(related, "feature", "left")
        .withColumn("dtype", types[F.col("feature")])
        .withColumn("feature_type", feature_kind(F.col("dtype"), F.col("unique_values")))
    )


def feature_kind(dtype: Column, unique: Column) -> Column:
    numeric = dtype.rlike("^(tinyint|smallint|int|bigint|float|double|decimal)")
    return F.when(unique == 2, "binary").when(numeric, "continuous").otherwise("categorical")


def model_kinds(df: DataFrame, columns: Sequence[str], coded: Sequence[str],
                most: int = 10) -> DataFrame:
    """(column, n_distinct, kind): few values or a coded column means categorical."""
    return distinct_counts(df, columns).withColumn(
        "kind",
        F.when((F.col("n_distinct") <= most) | F.col("column").isin(*coded), "categorical")
        .otherwise("numerical"),
    )


def column_totals(before: DataFrame, after: DataFrame) -> DataFrame:
    """Original, engineered and total column counts, with the row count."""
    made = len(after.columns) - len(before.columns)
    return after.agg(F.count("*").alias("row_count")).select(
        "row_count", F.lit(len(before.columns)).alias("original"),
        F.lit(made).alias("engineered"), F.lit(len(after.columns)).alias("total"),
    )
