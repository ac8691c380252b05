"""File sources and sinks: CSV with null tokens, snapshots, JSON and record tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.operators.clean import null_tokens
from wardline.session import staged
from wardline.sources.layout import NULL_TOKENS


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType,
    tokens: Sequence[str] = NULL_TOKENS,
) -> DataFrame:
    """CSV scan with a set of null tokens and a declared schema.

    The CSV reader knows one null token only, so fields are read as text, tokens
    removed, and the declared types applied; text that does not fit becomes NULL.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    raw = null_tokens(
        spark.read.schema(text).option("header", True).option("mode", "PERMISSIVE")
        .option("escape", '"').csv(path),
        tokens,
    )
    return raw.select(*[
        F.col(f"`{f.name}`") if isinstance(f.dataType, T.StringType)
        else F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name)
        for f in schema
    ])


class Scan(NamedTuple):
    """Rows that fit the schema, and the others: the line, as far as it was read, and the reason."""

    rows: DataFrame
    rejected: DataFrame


def header_name(name: str) -> str:
    """A header's name as columns are written here: blanks around it do not count, hyphens are underscores."""
    return name.strip().replace("-", "_")


def header_order(names: Sequence[str], schema: T.StructType) -> list[str | None]:
    """The schema's column at each place of a header, or none. Columns are found by name, case aside; a column that is
    missing or there twice raises ``ValueError``."""
    wanted = {f.name.lower(): f.name for f in schema}
    found = [wanted.get(header_name(n).lower()) for n in names]
    missing = [f.name for f in schema if f.name not in found]
    twice = sorted({n for n in found if n and found.count(n) > 1})
    if missing or twice:
        raise ValueError(f"header lacks {missing}, repeats {twice}")
    return found


def scan_csv(spark: SparkSession, path: str, schema: T.StructType, tokens: Sequence[str] = NULL_TOKENS) -> Scan:
    """CSV scan by header name that keeps what it cannot read.

    Columns may stand in any order, others are left out; every file must have the same header, which the reader checks. A
    line of another number of fields is rejected for ``fields``; one in which a known value does not fit its declared type
    for the first such column. Rows and rejected lines add up to the lines of the files; they are written once and
    read by both results.
    """
    names = spark.read.option("header", True).option("escape", '"').option("inferSchema", False).csv(path).columns
    order = header_order(names, schema)
    fields = [T.StructField(n, T.StringType()) for n in names] + [T.StructField("_line", T.StringType())]
    lines = (spark.read.schema(T.StructType(fields)).option("header", True).option("enforceSchema", False)
             .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line").option("columnPruning", False).option("escape", '"').csv(path))
    places = {c: names[i] for i, c in enumerate(order) if c}
    known = null_tokens(lines.select("_line", *[F.col(f"`{places[f.name]}`").alias(f.name) for f in schema]), tokens)
    typed, reason = [], F.when(F.col("_line").isNotNull(), F.lit("fields"))
    for f in schema:
        value = F.col(f"`{f.name}`")
        if not isinstance(f.dataType, T.StringType):
            reason = reason.when(value.isNotNull() & value.try_cast(f.dataType).isNull(), F.lit(f.name))
            value = value.try_cast(f.dataType)
        typed.append(value.alias(f.name))
    text = F.coalesce("_line", F.concat_ws(",", *[F.coalesce(F.col(f"`{f.name}`"), F.lit("")) for f in schema]))
    read = staged(known.select(*typed, text.alias("_text"), reason.alias("_reason")), "scan")
    columns = [F.col(f"`{f.name}`") for f in schema]
    return Scan(read.where("_reason is null").select(*columns),
                read.where("_reason is not null").select(F.col("_text").alias("line"), F.col("_reason").alias("reason")))


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV scan of a stage this library wrote."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_snapshot(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "error"
) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).json(path)


def write_reports(reports: Mapping[str, DataFrame], folder: str, mode: str = "error") -> None:
    """Each report table as CSV under its own name."""
    for name, df in reports.items():
        write_csv(df, f"{folder.rstrip('/')}/{name}", mode)


def first_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first ``n`` rows by key."""
    return df.orderBy(key).limit(n)
