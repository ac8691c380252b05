"""Label codes, one-hot columns, target codes and train-only scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.ml.feature import OneHotEncoder, StringIndexerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from wardline.operators.ordering import running_sums
from wardline.operators.profile import distinct_counts
from wardline.operators.reshape import aggregates, row_per_column, value_counts
from wardline.session import cut_lineage

VOCABULARY_LIMIT = 100_000


def _known(column: str) -> Column:
    """Text of a categorical value; NULL is a category of its own."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("nan"))


def label_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, code): codes count from 0 in text order within each column."""
    named = df.select(*[_known(c).alias(c) for c in columns])
    # Counted, sized and read by the callers; written once so the scan is not repeated.
    values = cut_lineage(value_counts(named, columns).select("column", "value", F.lit(1).alias("one")))
    ranked = running_sums(values, ["value"], ["one"], ["column"])
    return ranked.select("column", "value", (F.col("cum_one") - 1).cast("int").alias("code"))


def label_encode(
    df: DataFrame, columns: Sequence[str], codes: DataFrame | None = None,
    limit: int = VOCABULARY_LIMIT, unseen: int | None = None,
) -> DataFrame:
    """Replace each column by its code; a value without a code gets ``unseen``.

    The smallest vocabularies, within ``limit`` entries in total, go through one index
    model; only a column whose own vocabulary is beyond that is joined. Every row stays.
    """
    columns = list(columns)
    codes = label_codes(df, columns) if codes is None else codes
    sizes = {r["column"]: r["n"] for r in codes.where(F.col("column").isin(columns))
             .groupBy("column").agg(F.count("*").alias("n")).collect()}  # one row a column
    narrow: list[str] = []
    for c in sorted(columns, key=lambda c: (sizes.get(c, 0), c)):
        if sum(sizes.get(x, 0) for x in narrow) + sizes.get(c, 0) <= limit:
            narrow.append(c)
    out = df.withColumns({f"_t_{c}": _known(c) for c in columns})
    if narrow:
        labels: dict[str, list[str]] = {c: [] for c in narrow}
        for r in codes.where(F.col("column").isin(narrow)).orderBy("code").collect():
            labels[r["column"]].append(r["value"])
        model = StringIndexerModel.from_arrays_of_labels(
            [labels[c] for c in narrow], inputCols=[f"_t_{c}" for c in narrow],
            outputCols=[f"_c_{c}" for c in narrow], handleInvalid="keep")
        out = model.transform(out).withColumns({
            f"_c_{c}": F.when(F.col(f"_c_{c}") < len(labels[c]), F.col(f"_c_{c}").cast("int"))
            for c in narrow})
    for c in columns:
        if c not in narrow:
            mine = codes.where(F.col("column") == c).select(
                F.col("value").alias(f"_t_{c}"), F.col("code").alias(f"_c_{c}"))
            out = out.join(mine, f"_t_{c}", "left")
    return out.select(*[
        F.coalesce(F.col(f"_c_{c}"), F.lit(unseen).cast("int")).alias(c) if c in columns
        else F.col(f"`{c}`") for c in df.columns])


def encoding_route(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n_distinct, method): two values or fewer get codes, others one-hot."""
    return distinct_counts(df, columns).withColumn(
        "method",
        F.when(F.col("n_distinct") <= 2, "label_encoding").otherwise("one_hot_encoding"))


def one_hot_wide(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """One 0/1 column per listed value; NULL gives all zeros."""
    made = {
        f"{column}_{v}": F.coalesce((F.col(f"`{column}`") == v).cast("int"), F.lit(0)) for v in values
    }
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != column],
                     *[e.alias(name) for name, e in made.items()])


def one_hot_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, code) of the values that are there; NULL is none of them."""
    values = value_counts(df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns]), columns)
    ranked = running_sums(values.where("value is not null").select("column", "value", F.lit(1).alias("one")),
                          ["value"], ["one"], ["column"])
    return ranked.select("column", "value", (F.col("cum_one") - 1).cast("int").alias("code"))


def one_hot_vectors(
    df: DataFrame, columns: Sequence[str], codes: DataFrame, limit: int = VOCABULARY_LIMIT,
) -> DataFrame:
    """One sparse vector per column, as long as its vocabulary in ``codes``.

    NULL and values without a code become the all-zero vector.
    """
    columns = list(columns)
    sizes = {r["column"]: r["n"] for r in codes.groupBy("column").agg(F.count("*").alias("n")).collect()}
    coded = label_encode(df.withColumns({f"_v_{c}": F.col(f"`{c}`") for c in columns}),
                         [f"_v_{c}" for c in columns],
                         codes.withColumn("column", F.concat(F.lit("_v_"), "column")), limit)
    # The place behind the vocabulary stands for none; the encoder leaves it out of the vector.
    coded = coded.withColumns({
        f"_v_{c}": F.when(F.col(f"`{c}`").isNotNull(), F.col(f"_v_{c}")) for c in columns})
    coded = coded.fillna({f"_v_{c}": sizes.get(c, 0) for c in columns}).withColumns({
        f"_v_{c}": F.col(f"_v_{c}").cast("double") for c in columns})
    last = df.sparkSession.createDataFrame(
        [[float(sizes.get(c, 0)) for c in columns]], [f"_v_{c}" for c in columns])
    encoder = OneHotEncoder(inputCols=[f"_v_{c}" for c in columns],
                            outputCols=[f"{c}_vec" for c in columns], dropLast=True)
    return encoder.fit(last).transform(coded).drop(*[f"_v_{c}" for c in columns])


class Encoding(NamedTuple):
    """What a fit learned: each column's method, and the codes of its values."""

    methods: dict[str, str]
    codes: DataFrame
    sizes: dict[str, int]

    def of(self, method: str) -> list[str]:
        return [c for c, m in self.methods.items() if m == method]


def fit_encoding(df: DataFrame, columns: Sequence[str] | None = None) -> Encoding:
    """Route every given column (all text columns if none are): codes for two values or
    fewer, one-hot otherwise; vocabularies are written once."""
    columns = [f.name for f in df.schema if isinstance(f.dataType, StringType)] if columns is None else list(columns)
    methods = {r["column"]: r["method"] for r in encoding_route(df, columns).collect()} if columns else {}
    methods = {c: methods[c] for c in columns}
    labels = [c for c in columns if methods[c] == "label_encoding"]
    hot = [c for c in columns if methods[c] != "label_encoding"]
    parts = [f(df, some) for f, some in ((label_codes, labels), (one_hot_codes, hot)) if some]
    codes = parts[0] if parts else df.sparkSession.createDataFrame([], "column string, value string, code int")
    for extra in parts[1:]:
        codes = codes.unionByName(extra)
    codes = cut_lineage(codes)
    sizes = {r["column"]: r["n"] for r in codes.groupBy("column").agg(F.count("*").alias("n")).collect()}
    return Encoding(methods, codes, sizes)


def encode(df: DataFrame, fitted: Encoding, wide: bool = False) -> DataFrame:
    """The table under a fitted encoding: codes in place, one-hot columns as sparse vectors.

    With ``wide`` every known value gets a 0/1 column, however many there are. A value that
    the fit did not see has a NULL code, or zeros.
    """
    labels, hot = fitted.of("label_encoding"), fitted.of("one_hot_encoding")
    out = label_encode(df, labels, fitted.codes) if labels else df
    if not hot:
        return out
    if not wide:
        return one_hot_vectors(out, hot, fitted.codes.where(F.col("column").isin(hot))).drop(*hot)
    listed: dict[str, list[str]] = {c: [] for c in hot}
    for r in fitted.codes.where(F.col("column").isin(hot)).orderBy("column", "code").collect():
        listed[r["column"]].append(r["value"])  # as many as the columns asked for
    made = [F.coalesce((F.col(f"`{c}`") == v).cast("int"), F.lit(0)).alias(f"{c}_{v}")
            for c in hot for v in listed[c]]
    return out.select(*[F.col(f"`{c}`") for c in out.columns if c not in hot], *made)


def fitted_map(fitted: Encoding) -> DataFrame:
    """(column, method, value, code): the code, or the place among the column's values."""
    routes = fitted.codes.sparkSession.createDataFrame(
        list(fitted.methods.items()), "column string, method string")
    return fitted.codes.join(F.broadcast(routes), "column").select("column", "method", "value", "code")


def fit_scaler(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column; a constant column divides by one."""
    row = train.agg(*aggregates(columns, mean=F.avg, std=F.stddev_pop)).first()
    return {c: (row[f"{c}|mean"], row[f"{c}|std"] or 1.0) for c in columns}


def scale(df: DataFrame, fitted: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({
        c: (F.col(c) - F.lit(mean)) / F.lit(std) for c, (mean, std) in fitted.items()
    })


def scaling_report(
    before: DataFrame, after: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """(feature, mean/std/min/max before and after), sample deviation."""
    fields = {f: "double" for f in ("mean", "std", "min", "max")}

    def stats(df: DataFrame, suffix: str) -> DataFrame:
        wide = df.agg(*aggregates(
            columns, mean=F.avg, std=F.stddev_samp, min=F.min, max=F.max))
        rows = row_per_column(wide, columns, fields, name="feature")
        return rows.select("feature", *[F.col(f).alias(f"{f}_{suffix}") for f in fields])

    return stats(before, "before").join(stats(after, "after"), "feature")
