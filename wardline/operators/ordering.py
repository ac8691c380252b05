"""Global order at scale: running sums, order statistics and hash cut-offs.

A window without a well-spread partition key puts a whole group in one task. The
operators here measure the input first; small inputs take the plain window, larger
ones are range-partitioned, written once, and joined with per-part offsets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardline.session import cut_lineage

ONE_TASK_ROWS = 1_000_000


def literal_rows(df: DataFrame, limit: int = 100_000) -> tuple[DataFrame, bool]:
    """``df`` computed once as literal rows when it has at most ``limit`` of them."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        return df, False
    return df.sparkSession.createDataFrame(rows, df.schema), True


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match each other; the keys appear once."""
    renamed = right.select(*[
        F.col(f"`{c}`").alias(f"_on_{c}") if c in on else F.col(f"`{c}`") for c in right.columns])
    test = F.lit(True)
    for c in on:
        test = test & F.col(f"`{c}`").eqNullSafe(F.col(f"`_on_{c}`"))
    return left.join(renamed, test, how).drop(*[f"_on_{c}" for c in on])


def with_small_side(
    big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "left",
    limit: int = 100_000,
) -> DataFrame:
    """Join ``small`` by broadcast once it is known to fit, by shuffle otherwise.

    The bound is read by fetching at most ``limit + 1`` rows; a side within it is
    then reused as literal rows, so it is computed once. NULL keys match each other.
    """
    literal, fits = literal_rows(small, limit)
    return null_safe_join(big, F.broadcast(literal) if fits else small, list(on), how)


def running_sums(
    df: DataFrame, order: Sequence[str], measures: Sequence[str],
    keys: Sequence[str] = (), descending: bool = False,
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Add ``cum_<measure>`` over a total order of ``order`` within each key.

    Rows must be unique per ``keys + order``: aggregate ties first. NULL keys are a key
    of their own on either path.
    """
    keys, order = list(keys), list(order)
    direction = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    total_rows = df.count()
    if total_rows <= one_task_rows:
        frame = W.partitionBy(*keys).orderBy(*direction).rowsBetween(
            W.unboundedPreceding, W.currentRow
        )
        return df.withColumns({f"cum_{m}": F.sum(m).over(frame) for m in measures})

    parts = max(2, -(-total_rows // one_task_rows)) * 2
    ranged = df.repartitionByRange(parts, *[F.col(k) for k in keys], *direction)
    # The part number must not change on a replay, so the ranged rows are written.
    staged = cut_lineage(ranged.withColumn("_part", F.spark_partition_id()))
    before = W.partitionBy(*keys).orderBy("_part").rowsBetween(
        W.unboundedPreceding, -1
    )
    offsets = (
        staged.groupBy(*keys, "_part")
        .agg(*[F.sum(m).alias(f"_sum_{m}") for m in measures])
        .select(
            *keys, "_part",
            *[F.coalesce(F.sum(f"_sum_{m}").over(before), F.lit(0)).alias(f"_off_{m}")
              for m in measures],
        )
    )
    local = W.partitionBy(*keys, "_part").orderBy(*direction).rowsBetween(
        W.unboundedPreceding, W.currentRow
    )
    summed = staged.withColumns({f"cum_{m}": F.sum(m).over(local) for m in measures})
    joined = null_safe_join(summed, offsets, keys + ["_part"])
    return joined.select(
        *df.columns,
        *[(F.col(f"cum_{m}") + F.col(f"_off_{m}")).alias(f"cum_{m}") for m in measures],
    )


def order_statistics(
    df: DataFrame, targets: Mapping[str, tuple[Column, int]],
    one_task_rows: int = ONE_TASK_ROWS, accuracy: int = 10_000,
) -> dict[str, object]:
    """Exact k-th smallest (from 0) non-NULL value for each named target.

    Scan-only: every round brackets all open targets between two approximate
    quantiles, counts exactly on each side, and keeps the bracket holding the rank.
    Brackets shrink by orders of magnitude and always exclude their end points, so
    the loop ends; no row is shuffled until a bracket fits one task.
    """
    found: dict[str, object] = {}
    state = {name: {"low": None, "high": None, "rank": k} for name, (_, k) in targets.items()}

    def inside(name: str) -> Column:
        value, bounds = targets[name][0], state[name]
        test = value.isNotNull()
        if bounds["low"] is not None:
            test = test & (value > F.lit(bounds["low"]))
        if bounds["high"] is not None:
            test = test & (value < F.lit(bounds["high"]))
        return test

    sizes = df.agg(*[F.count_if(inside(n)).alias(n) for n in targets]).first()
    for name in targets:
        state[name]["size"] = sizes[name]

    while True:
        wide = [n for n in targets if n not in found and state[n]["size"] > one_task_rows]
        if not wide:
            break
        guesses = []
        for name in wide:
            at = state[name]["rank"] / max(state[name]["size"] - 1, 1)
            span = [max(0.0, at - 2 / accuracy), min(1.0, at + 2 / accuracy)]
            kept = F.when(inside(name), targets[name][0])
            guesses.append(F.percentile_approx(kept, span, accuracy).alias(name))
        marks = df.agg(*guesses).first()
        counts = []
        for name in wide:
            value, (lo, hi) = targets[name][0], marks[name]
            held = inside(name)
            counts += [
                F.count_if(held & (value < F.lit(lo))).alias(f"{name}|below"),
                F.count_if(held & (value == F.lit(lo))).alias(f"{name}|low"),
                F.count_if(held & (value < F.lit(hi))).alias(f"{name}|under"),
                F.count_if(held & (value == F.lit(hi))).alias(f"{name}|high"),
            ]
        tally = df.agg(*counts).first()
        for name in wide:
            (lo, hi), mine = marks[name], state[name]
            rank, below = mine["rank"], tally[f"{name}|below"]
            upto_low = below + tally[f"{name}|low"]
            under = max(tally[f"{name}|under"], upto_low)
            upto_high = under + (tally[f"{name}|high"] if hi != lo else 0)
            if rank < below:
                mine.update(high=lo, size=below)
            elif rank < upto_low:
                found[name] = lo
            elif rank < under:
                mine.update(low=lo, high=hi, rank=rank - upto_low, size=under - upto_low)
            elif rank < upto_high:
                found[name] = hi
            else:
                mine.update(low=hi, rank=rank - upto_high, size=mine["size"] - upto_high)

    # Targets that ended in the same bracket of the same column share one pass.
    shared: dict[tuple, list[str]] = {}
    for name, (value, _) in targets.items():
        if name not in found:
            place = (str(value), state[name]["low"], state[name]["high"])
            shared.setdefault(place, []).append(name)
    for names in shared.values():
        value = targets[names[0]][0]
        held = (
            df.where(inside(names[0])).groupBy(value.alias("value"))
            .agg(F.count("*").alias("n"))
        )
        upto = W.orderBy("value").rowsBetween(W.unboundedPreceding, W.currentRow)
        ranked = held.withColumn("upto", F.sum("n").over(upto))
        row = ranked.agg(*[
            F.min(F.when(F.col("upto") > state[n]["rank"], F.col("value"))).alias(n)
            for n in names]).first()
        found.update({n: row[n] if state[n]["rank"] >= 0 else None for n in names})
    return found


def hash_cutoffs(
    df: DataFrame, digest: Column, group: Sequence[str],
    wanted: Mapping[str, Column], prefix: int = 4,
) -> DataFrame:
    """Per group, the digest of the row at each wanted rank (counting from 1).

    ``wanted`` maps an output name to an expression over ``n``, the group size; a rank
    below 1 gives the empty string, which no digest reaches. Rows are counted by digest
    prefix, so only the few buckets holding a boundary are ever ordered, and a group
    with most of the rows is spread over all buckets.
    """
    group = list(group)
    slim = df.select(*group, digest.alias("_digest")).withColumn(
        "_bucket", F.substring("_digest", 1, prefix)
    )
    per_bucket = slim.groupBy(*group, "_bucket").agg(F.count("*").alias("_size"))
    by_group = W.partitionBy(*group)
    upto = by_group.orderBy("_bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = per_bucket.select(
        *group, "_bucket", "_size",
        F.sum("_size").over(upto).alias("_upto"),
        F.sum("_size").over(by_group).alias("n"),
    )
    ranks = F.map_from_arrays(
        F.array(*[F.lit(name) for name in wanted]),
        F.array(*[expr.cast("bigint") for expr in wanted.values()]),
    )
    spread = placed.select(
        *group, "_bucket", (F.col("_upto") - F.col("_size")).alias("_before"), "_upto",
        F.explode(ranks).alias("_name", "_rank"),
    )
    boundary = spread.where(
        (F.col("_rank") > F.col("_before")) & (F.col("_rank") <= F.col("_upto"))
    )
    boundary, fits = literal_rows(
        boundary.select(
            *group, "_bucket", "_name",
            (F.col("_rank") - F.col("_before")).cast("int").alias("_pos"),
        )
    )
    needed = boundary.select(*group, "_bucket").distinct()
    in_bucket = W.partitionBy(*group, "_bucket").orderBy("_digest")
    ranked = slim.join(
        F.broadcast(needed) if fits else needed, group + ["_bucket"], "left_semi"
    ).withColumn("_pos", F.row_number().over(in_bucket))
    hits = (
        ranked.join(
            F.broadcast(boundary) if fits else boundary, group + ["_bucket", "_pos"]
        )
        .groupBy(*group)
        .agg(*[F.max(F.when(F.col("_name") == name, F.col("_digest"))).alias(name)
               for name in wanted])
    )
    sizes = per_bucket.groupBy(*group).agg(F.sum("_size").alias("n"))
    return sizes.join(hits, group, "left").select(
        *group, "n", *[F.coalesce(F.col(name), F.lit("")).alias(name) for name in wanted]
    )
