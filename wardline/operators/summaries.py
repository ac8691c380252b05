"""Column summaries that merge: a profile of appended data without reading the old data again.

A summary has a row for each column: counts, moments, extremes, a sketch of the distinct values and one of the
distribution. Summaries of parts are merged by one small aggregate, in any order; counts and extremes are exact,
moments up to rounding, distinct counts and quantiles within the sketches' bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.functions.stats import percent
from wardline.operators.clean import columns_of_kind

#: Sizes of the sketches: standard error of a distinct count 1.04 / sqrt(2 ** DISTINCT), error of a rank under 1 in 100.
DISTINCT, RANKS = 14, 400
#: Quantiles that stand for a distribution where its bins are counted.
POINTS = 400


def summarise(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n, known, mean, m2, low, high, distinct, ranks) in one pass.

    ``m2`` is the sum of squared differences from the mean, ``distinct`` and ``ranks`` are sketches. Moments, extremes and
    ranks are null for columns that are not numbers. A table without rows has a summary of zeros.
    """
    columns = list(columns or df.columns)
    numbers = {c for c in columns_of_kind(df, True) if c in columns}

    def entry(c: str):
        value = F.col(f"`{c}`")
        number = value.cast("double") if c in numbers else F.lit(None).cast("double")
        return F.struct(
            F.lit(c).alias("column"), F.count("*").alias("n"), F.count(value).alias("known"),
            F.avg(number).alias("mean"), (F.var_pop(number) * F.count(number)).alias("m2"),
            F.min(number).alias("low"), F.max(number).alias("high"),
            # A null has a hash of its own, which the sketch must not see.
            F.hll_sketch_agg(F.when(value.isNotNull(), F.xxhash64(value)), F.lit(DISTINCT)).alias("distinct"),
            (F.kll_sketch_agg_double(number, F.lit(RANKS)) if c in numbers else F.lit(None).cast("binary")).alias("ranks"))

    wide = df.agg(F.array(*[entry(c) for c in columns]).alias("_columns"))
    return wide.select(F.explode("_columns").alias("_c")).select("_c.*")


def store_summary(summary: DataFrame, path: str, batch: str) -> None:
    """Keep a batch's summary; one that is stored again replaces itself."""
    summary.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def stored_summaries(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def merge(summaries: DataFrame) -> DataFrame:
    """One summary of all: rows of a column become one, whichever batches they are of."""
    means = summaries.groupBy("column").agg(
        (F.sum(F.col("mean") * F.col("known")) / F.nullif(F.sum(F.when(F.col("mean").isNotNull(), F.col("known"))), F.lit(0))).alias("_mean"))
    moved = summaries.join(means, "column").withColumn(
        "m2", F.col("m2") + F.col("known") * (F.col("mean") - F.col("_mean")) * (F.col("mean") - F.col("_mean")))
    merged = moved.groupBy("column").agg(
        F.sum("n").alias("n"), F.sum("known").alias("known"), F.first("_mean").alias("mean"), F.sum("m2").alias("m2"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double(F.when(F.col("mean").isNotNull(), F.col("ranks"))).alias("ranks"))
    return merged.withColumn("ranks", F.when(F.col("mean").isNotNull(), F.col("ranks")))


def profile(summary: DataFrame) -> DataFrame:
    """(column, n, missing_count, missing_pct, n_distinct, mean, std, min, max, p25, p50, p75) of a summary; distinct counts
    and quartiles are estimates. Quartiles are values of the column."""
    def quantile(q: float):
        return F.when(F.col("mean").isNotNull(), F.kll_sketch_get_quantile_double("ranks", F.lit(q)))

    missing = F.col("n") - F.col("known")
    return summary.select(
        "column", "n", missing.alias("missing_count"),
        F.coalesce(percent(missing, F.col("n"), 2), F.lit(0.0)).alias("missing_pct"),
        F.hll_sketch_estimate("distinct").alias("n_distinct"), "mean",
        F.sqrt(F.col("m2") / F.nullif(F.col("known") - 1, F.lit(0))).alias("std"),
        F.col("low").alias("min"), F.col("high").alias("max"),
        quantile(0.25).alias("p25"), quantile(0.5).alias("p50"), quantile(0.75).alias("p75"))


def histogram(summary: DataFrame, bins: int) -> DataFrame:
    """(column, bin, bin_start, bin_end, n): equal bins between the extremes with estimated counts, the last one closed.
    The counts of a column add up to its known values."""
    points = F.array(*[F.lit((i + 0.5) / POINTS) for i in range(POINTS)])
    known = summary.where(F.col("mean").isNotNull()).select(
        "column", "known", "low", "high", ((F.col("high") - F.col("low")) / bins).alias("_w"),
        F.kll_sketch_get_quantile_double("ranks", points).alias("_q"))
    cut = known.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))

    def below(edge):
        """How many values are less than an edge."""
        return F.round(F.size(F.filter("_q", lambda v: v < edge)) / POINTS * F.col("known"))

    start, end = F.col("low") + F.col("bin") * F.col("_w"), F.col("low") + (F.col("bin") + 1) * F.col("_w")
    last = F.col("bin") == bins - 1
    upto = F.when(last | (F.col("_w") == 0), F.col("known")).otherwise(below(end))
    return cut.select(
        "column", "bin", start.alias("bin_start"), F.when(last, F.col("high")).otherwise(end).alias("bin_end"),
        (upto - F.when(F.col("bin") == 0, 0).when(F.col("_w") == 0, F.col("known")).otherwise(below(start))).cast("bigint").alias("n"))
