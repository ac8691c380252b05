"""Guarded numeric expressions (ANSI mode stays on)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(num: Column, den: Column) -> Column:
    """Division that yields NULL, not an error, on a zero divisor."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def pearson(x: Column, y: Column) -> Column:
    """Pairwise-complete Pearson correlation; NULL when either side is constant."""
    x, y = x.cast("double"), y.cast("double")
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))


def percent(part: Column, whole: Column, places: int | None = None) -> Column:
    value = ratio(part, whole) * 100
    return value if places is None else F.round(value, places)


def right_closed(value: Column, edges: Sequence[float], codes: Sequence[float]) -> Column:
    """Code of the interval ``(edge[i], edge[i+1]]`` holding ``value``; NULL outside."""
    chain = F.when(value <= edges[0], F.lit(None).cast("double"))
    for upper, code in zip(edges[1:], codes):
        chain = chain.when(value <= upper, F.lit(float(code)))
    return chain


def clamp(value: Column, low: float, high: float) -> Column:
    """Limit to ``[low, high]``; a NULL stays NULL."""
    return F.when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value)


def flag(predicate: Column, unknown: bool = False) -> Column:
    """0/1 from a predicate, with NULL read as ``unknown``."""
    return F.coalesce(predicate, F.lit(unknown)).cast("int")


def any_of(tests: Sequence[Column]) -> Column:
    """Whether some test is true; NULL tests count as false."""
    out = F.lit(False)
    for test in tests:
        out = out | F.coalesce(test, F.lit(False))
    return out


def with_rounded_tenth(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add ``value`` rounded to one place by its exact binary value, ties to even.

    The built-in ``round`` works on the shortest decimal text, so 45.65, which is
    stored slightly below, would go up. Ten times the value is 8x + 2x, both exact;
    the rounding error of that sum decides a seeming tie. Each step is a column of its
    own, so the expressions stay small enough to compile.
    """
    v, s = F.col("_value"), F.col("_ten")
    staged = df.withColumn("_value", value).withColumn("_ten", v * 8.0 + v * 2.0)
    staged = staged.withColumns({
        "_back": s - v * 8.0, "_base": F.floor(s).cast("double")})
    staged = staged.withColumn(
        "_error", (v * 8.0 - (s - F.col("_back"))) + (v * 2.0 - F.col("_back")))
    part, error = s - F.col("_base"), F.col("_error")
    even = (F.col("_base") % 2.0) == 0.0
    down = (part < 0.5) | ((part == 0.5) & ((error < 0) | ((error == 0) & even)))
    tenths = F.when(down, F.col("_base")).when(part.isNotNull(), F.col("_base") + 1.0)
    return staged.withColumn(name, tenths / 10.0).drop(
        "_value", "_ten", "_back", "_base", "_error")
