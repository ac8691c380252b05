"""Null tokens, imputation, type repair, de-duplication and winsorising.

Fits return small parameter sets (one entry per column); transforms are narrow
projections, so the chain adds no shuffle besides the de-duplication.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.functions.stats import clamp
from wardline.operators.quantiles import column_quantiles
from wardline.operators.reshape import value_counts
from wardline.session import staged

#: Keys that come more than once are sent to every task up to this number.
REPEATED_KEYS = 500_000


def columns_of_kind(df: DataFrame, numeric: bool) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) is numeric]


def drop_if_present(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.drop(*columns)


def null_tokens(df: DataFrame, tokens: Sequence[str]) -> DataFrame:
    """Replace the tokens by NULL in every string column."""
    return df.select(*[
        F.when(~F.col(f"`{f.name}`").isin(*tokens), F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema
    ])


def columns_with_gaps(df: DataFrame) -> list[str]:
    """Columns holding at least one NULL, found in one pass."""
    known = df.agg(
        F.count("*").alias("_rows"), *[F.count(f"`{c}`").alias(c) for c in df.columns]).first()
    return [c for c in df.columns if known[c] < known["_rows"]]


def fit_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Median of every given numeric column."""
    fitted = column_quantiles(df, columns, [0.5])
    return {c: q[0] for c, q in fitted.items() if q[0] is not None}


def fit_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent value, the smallest on ties, of every given column."""
    if not columns:
        return {}
    best = (
        value_counts(df, columns).where("value is not null").groupBy("column")
        .agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))
    )
    return {r["column"]: r["mode"] for r in best.collect()}


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace NULL by the column's value.

    A whole-number column whose value is not whole becomes double first, so that the value
    is filled in as it is.
    """
    whole = {f.name for f in df.schema if isinstance(f.dataType, T.IntegralType)}
    halves = [c for c, v in values.items() if c in whole and isinstance(v, float) and v != int(v)]
    df = df.withColumns({c: F.col(f"`{c}`").cast("double") for c in halves})
    return df.fillna(dict(values)) if values else df


def imputation_log(df: DataFrame, medians: Mapping, modes: Mapping) -> DataFrame:
    """(column, strategy, value) for every imputed column."""
    rows = [(c, "median", str(float(v))) for c, v in medians.items()]
    rows += [(c, "mode", str(v)) for c, v in modes.items()]
    return df.sparkSession.createDataFrame(rows, "column string, strategy string, value string")


def to_number(df: DataFrame, columns: Sequence[str], kind: str = "double") -> DataFrame:
    """Numeric coercion; text that is no number becomes NULL."""
    return df.withColumns({c: F.col(f"`{c}`").try_cast(kind) for c in columns})


def to_category(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(f"`{c}`").cast("string") for c in columns})


def type_changes(before: DataFrame, after: DataFrame) -> list[tuple[str, str, str]]:
    """(column, from, to) where a conversion changed the type."""
    new = dict(after.dtypes)
    return [(c, t, new[c]) for c, t in before.dtypes if c in new and new[c] != t]


def conversion_log(before: DataFrame, after: DataFrame) -> DataFrame:
    """(column, from, to) of the columns whose type a conversion changed."""
    return before.sparkSession.createDataFrame(type_changes(before, after), "column string, from string, to string")


def fit_input_medians(train: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """The imputer of the model inputs: a median of every feature, from the training rows; 0 where none is known."""
    return dict.fromkeys(features, 0.0) | fit_medians(train, features)


def repeated_keys(df: DataFrame, key: str, most: int = REPEATED_KEYS) -> DataFrame | None:
    """``(_key)`` of the keys that come more than once, NULL too; nothing where they are more than ``most``."""
    counts = df.groupBy(F.col(f"`{key}`").alias("_key")).agg(F.count("*").alias("_n"))
    found = staged(counts.where("_n > 1").select("_key"), "repeated")
    return found if found.limit(most + 1).count() <= most else None


def by_key(df: DataFrame, repeated: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of keys that come once, and the others."""
    same = F.col(f"`{key}`").eqNullSafe(F.col("_key"))
    return df.join(F.broadcast(repeated), same, "left_anti"), df.join(F.broadcast(repeated), same, "left_semi")


def distinct_rows(df: DataFrame, key: str | None = None, most: int = REPEATED_KEYS) -> DataFrame:
    """Full-row de-duplication; identical rows combine before the shuffle.

    Equal rows have equal keys, so with ``key``, a column of few repeats, keys are counted first and only rows of
    a key that comes twice are grouped whole; the others stay where they are. Where more than ``most`` keys come
    twice, all rows are grouped. ``df`` is read twice and must be the same both times.
    """
    repeated = None if key is None else repeated_keys(df, key, most)
    if repeated is None:
        return df.distinct()
    if repeated.isEmpty():
        return df
    once, again = by_key(df, repeated, key)
    return once.unionByName(again.distinct())


def counted_rows(df: DataFrame, gaps: Sequence[str], key: str | None = None, most: int = REPEATED_KEYS) -> DataFrame:
    """``distinct_rows`` with ``_copies``, the number of equal rows, and the sums of the 0/1 columns ``gaps`` over them.
    The columns ``gaps`` are no part of a row."""
    columns = [F.col(f"`{c}`") for c in df.columns if c not in gaps]

    def grouped(rows):
        return rows.groupBy(*columns).agg(F.count("*").alias("_copies"), *[F.sum(f"`{c}`").alias(c) for c in gaps])

    repeated = None if key is None else repeated_keys(df, key, most)
    if repeated is None:
        return grouped(df)
    once, again = (df, None) if repeated.isEmpty() else by_key(df, repeated, key)
    single = once.select(*columns, F.lit(1).cast("bigint").alias("_copies"), *[F.col(f"`{c}`").cast("bigint").alias(c) for c in gaps])
    return single if again is None else single.unionByName(grouped(again))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Each repeated row once, with the number of surplus copies."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    return (
        df.groupBy(*columns).agg((F.count("*") - 1).alias("surplus")).where("surplus > 0")
    )


def fit_outliers(
    df: DataFrame, columns: Sequence[str], multiplier: float = 1.5,
    low: float = 0.01, high: float = 0.99,
) -> dict[str, dict[str, float]]:
    """Quartiles, fences and caps per column; every value is exact."""
    fitted = column_quantiles(df, columns, [low, 0.25, 0.75, high])
    out = {}
    for c, (cap_low, q1, q3, cap_high) in fitted.items():
        if q1 is None:
            continue
        spread = q3 - q1
        out[c] = {
            "q1": q1, "q3": q3, "iqr": spread,
            "lower_fence": q1 - multiplier * spread, "upper_fence": q3 + multiplier * spread,
            "cap_lower": cap_low, "cap_upper": cap_high,
        }
    return out


def outlier_report(df: DataFrame, fitted: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """The fitted values with the number of rows outside each pair of fences."""
    counted = df.agg(*[
        F.count_if((F.col(c) < p["lower_fence"]) | (F.col(c) > p["upper_fence"])).alias(c)
        for c, p in fitted.items()
    ])
    entries = F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            *[F.lit(float(p[k])).alias(k) for k in (
                "q1", "q3", "iqr", "lower_fence", "upper_fence", "cap_lower", "cap_upper")],
            F.col(c).alias("outliers_found"),
        )
        for c, p in fitted.items()
    ])
    return counted.select(F.explode(entries).alias("_e")).select("_e.*")


def winsorise(df: DataFrame, fitted: Mapping[str, Mapping[str, float]]) -> DataFrame:
    return df.withColumns({
        c: clamp(F.col(c).cast("double"), float(p["cap_lower"]), float(p["cap_upper"]))
        for c, p in fitted.items()
    })
