"""The cleaning chain, and the model table built from it."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.operators import clean
from wardline.session import ROWS_A_TASK, read_in_parts, small_methods, staged
from wardline.sources.layout import CATEGORICAL, KEY, NULL_TOKENS, NUMERIC, PATIENT, TARGET


@dataclass
class CleaningParams:
    """What the cleaning chain learns from a table: one entry per column."""

    medians: dict[str, float] = field(default_factory=dict)
    modes: dict[str, str] = field(default_factory=dict)
    outliers: dict[str, dict[str, float]] = field(default_factory=dict)


def impute_and_type(
    raw: DataFrame, params: CleaningParams | None = None, flags: bool = False
) -> tuple[DataFrame, CleaningParams]:
    """Null tokens out, gaps filled, declared types enforced. With ``flags`` a column ``_gap_<column>`` for each says
    whether it was a gap, 1 or 0."""
    known = clean.null_tokens(raw, NULL_TOKENS)
    if params is None:
        with small_methods(raw.sparkSession):
            lacking = set(clean.columns_with_gaps(known)) - {KEY, PATIENT}
        params = CleaningParams(
            medians=clean.fit_medians(
                known, [c for c in clean.columns_of_kind(known, True) if c in lacking]),
            modes=clean.fit_modes(
                known, [c for c in clean.columns_of_kind(known, False) if c in lacking]),
        )
    if flags:
        known = known.withColumns({f"_gap_{c}": F.col(f"`{c}`").isNull().cast("int") for c in known.columns})
    filled = clean.fill(clean.fill(known, params.medians), params.modes)
    numbers = [c for c in NUMERIC if c in filled.columns]
    categories = [c for c in CATEGORICAL if c in filled.columns]
    return clean.to_category(clean.to_number(filled, numbers), categories), params


def _metrics(kept: DataFrame, columns: list[str]) -> dict[str, dict[str, int]]:
    counts = kept.agg(
        F.count("*").alias("after"), F.coalesce(F.sum("_copies"), F.lit(0)).alias("before"),
        *[F.count(f"`{c}`").alias(f"after_{c}") for c in columns],
        *[F.coalesce(F.sum(f"`_gap_{c}`"), F.lit(0)).alias(f"gaps_{c}") for c in columns]).first()
    return {"before": {"rows": counts["before"]} | {f"known_{c}": counts["before"] - counts[f"gaps_{c}"] for c in columns},
            "after": {"rows": counts["after"]} | {f"known_{c}": counts[f"after_{c}"] for c in columns}}


def prepare(
    raw: DataFrame, params: CleaningParams | None = None, metrics: dict[str, dict[str, int]] | None = None
) -> tuple[DataFrame, CleaningParams]:
    """The full chain up to winsorised, un-encoded rows.

    ``metrics``, if given, gets ``before`` and ``after``: rows, and ``known_<column>`` cells. What was before is carried
    through the shuffle of the distinct rows, as copies and gaps of each, and read with what is after in one aggregate
    over the written rows; the raw rows are not read again, and a stage that is run twice counts once.

    The distinct rows are written once, so the fence fit and every later stage read back only the columns they need.
    Keys are counted first; whole rows are grouped, the one wide shuffle, only where a key comes twice. A task reads a
    bounded number of rows.
    """
    typed, params = impute_and_type(raw, params, metrics is not None)
    parts = -(-raw.count() // ROWS_A_TASK)
    key = KEY if KEY in typed.columns else None
    if metrics is None:
        with read_in_parts(raw.sparkSession, parts), small_methods(raw.sparkSession):
            unique = staged(clean.distinct_rows(typed, key), "distinct")
    else:
        columns = [c for c in typed.columns if not c.startswith("_gap_")]
        gaps = [f"_gap_{c}" for c in columns]
        with read_in_parts(raw.sparkSession, parts), small_methods(raw.sparkSession):
            kept = staged(clean.counted_rows(typed, gaps, key), "distinct")
        unique = kept.select(*[F.col(f"`{c}`") for c in columns])
        metrics |= _metrics(kept, columns)
    if not params.outliers:
        params.outliers = clean.fit_outliers(unique, [c for c in NUMERIC if c in unique.columns])
    return clean.winsorise(unique, params.outliers), params


def binary_target(df: DataFrame, name: str = "label") -> DataFrame:
    """1 for an early return, 0 for a late or no return; other rows are left out."""
    label = F.when(F.col(TARGET) == "<30", 1).when(F.col(TARGET).isin(">30", "NO"), 0)
    return df.withColumn(name, label).where(F.col(name).isNotNull())
