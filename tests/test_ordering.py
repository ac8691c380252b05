"""Order operators against brute force, on both the small and the spread path."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardline.functions.codes import order_hash
from wardline.operators.ordering import hash_cutoffs, order_statistics, running_sums
from wardline.operators.quantiles import column_quantiles, grouped_quantiles
from wardline.operators.split import stratified_split


@pytest.mark.parametrize("limit", [10_000, 100])
@pytest.mark.parametrize("descending", [False, True])
def test_running_sums(spark, limit, descending):
    rng = random.Random(1)
    # One key holds nine tenths of the rows.
    rows = [("hot" if i % 10 else "cold", i * 7 % 1009 + i / 1e4, rng.randrange(5))
            for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, v double, m bigint").repartition(5)
    got = {(r.k, r.v): r.cum_m for r in running_sums(
        df, ["v"], ["m"], ["k"], descending, one_task_rows=limit).collect()}
    assert len(got) == len(rows)
    for key in ("hot", "cold"):
        total = 0
        for k, v, m in sorted((r for r in rows if r[0] == key), key=lambda r: r[1],
                              reverse=descending):
            total += m
            assert got[k, v] == total


@pytest.mark.parametrize("values", [
    [float(i * i % 997) for i in range(5000)],
    [1.0] * 4000 + [2.0] * 1000,
    [1.0] * 2500 + [7.0] * 2500,
    [math.exp(i / 100) for i in range(3000)],
])
def test_order_statistics_narrow_down_to_the_exact_value(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(4)
    ranks = [0, 1, len(values) // 3, len(values) // 2, len(values) - 1, len(values)]
    got = order_statistics(
        df, {str(k): (F.col("v"), k) for k in ranks}, one_task_rows=20, accuracy=50)
    ordered = sorted(values) + [None]
    assert [got[str(k)] for k in ranks] == [ordered[k] for k in ranks]


@pytest.mark.parametrize("limit", [100_000, 10])
def test_quantiles_interpolate(spark, limit):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=1501), rng.integers(0, 9, 1501).astype(float)
    df = spark.createDataFrame(
        [("x" if i % 3 else "y", float(p), float(q)) for i, (p, q) in enumerate(zip(a, b))],
        "g string, a double, b double")
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    whole = column_quantiles(df, ["a", "b"], probs, limit=limit, one_task_rows=50)
    np.testing.assert_allclose(whole["a"], np.quantile(a, probs), rtol=1e-12)
    np.testing.assert_allclose(whole["b"], np.quantile(b, probs), rtol=1e-12)
    parts = {(r.g, r.column): r.q for r in grouped_quantiles(
        df, ["g"], ["a", "b"], probs, limit=limit, one_task_rows=50).collect()}
    inside = np.array([i % 3 != 0 for i in range(1501)])
    for name, col in (("a", a), ("b", b)):
        np.testing.assert_allclose(parts["x", name], np.quantile(col[inside], probs), rtol=1e-12)
        np.testing.assert_allclose(parts["y", name], np.quantile(col[~inside], probs), rtol=1e-12)


@pytest.mark.parametrize("prefix", [1, 4])
def test_hash_cutoffs_are_the_ranked_digests(spark, prefix):
    import hashlib

    rows = [(i, "hot" if i % 9 else "cold") for i in range(900)]
    df = spark.createDataFrame(rows, "k bigint, g string")
    cut = {r.g: r for r in hash_cutoffs(
        df, order_hash(F.col("k")), ["g"],
        {"half": F.floor(F.col("n") / 2), "none": F.lit(0)}, prefix).collect()}
    for g in ("hot", "cold"):
        digests = sorted(hashlib.md5(f"{k}:42".encode()).hexdigest() for k, c in rows if c == g)
        assert cut[g].n == len(digests)
        assert cut[g].half == digests[len(digests) // 2 - 1]
        assert cut[g].none == ""


def test_split_is_exact_disjoint_and_independent_of_partitioning(spark):
    rows = [(i, 1 if i % 9 == 0 else 0) for i in range(2003)]
    df = spark.createDataFrame(rows, "k bigint, label int")
    one = {r.k: r.split for r in stratified_split(df.repartition(3), "k", "label").collect()}
    two = {r.k: r.split for r in stratified_split(df.repartition(11), "k", "label").collect()}
    assert one == two and len(one) == 2003
    for label in (0, 1):
        n = sum(1 for _, c in rows if c == label)
        count = {s: sum(1 for k, c in rows if c == label and one[k] == s)
                 for s in ("train", "val", "test")}
        assert count["train"] == n * 70 // 100
        assert count["train"] + count["val"] == n * 85 // 100


def test_split_of_a_tiny_class(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "k bigint, label int")
    got = {r.k: r.split for r in stratified_split(df, "k", "label").collect()}
    assert got[1] == "test" and len(got) == 3


@pytest.mark.parametrize("limit", [10_000, 20])
def test_null_keys_are_keys_on_either_path(spark, limit):
    rows = [(None if i % 2 else "a", float(i), 1) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, v double, m bigint").repartition(3)
    got = {(r.k, r.v): r.cum_m for r in running_sums(df, ["v"], ["m"], ["k"], one_task_rows=limit).collect()}
    assert got == {(k, v): int(v) // 2 + 1 for k, v, _ in rows}


@pytest.mark.parametrize("distinct, limit", [(1_000, 10_000), (1, 10_000), (1, 20)])
def test_quantiles_of_null_and_empty_groups(spark, distinct, limit):
    rows = [(None, float(i)) for i in range(101)] + [("a", float(i)) for i in range(51)] + [("none", None)] * 3
    df = spark.createDataFrame(rows, "k string, v double").repartition(3)
    got = {r.k: r.q for r in grouped_quantiles(df, ["k"], ["v"], [0.25, 0.5], limit=distinct, one_task_rows=limit).collect()}
    assert got == {None: [25.0, 50.0], "a": [12.5, 25.0], "none": None}


def test_rows_without_a_label_stay_without_a_split(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else i % 2) for i in range(80)], "k bigint, y int")
    rows = stratified_split(df, "k", "y").collect()
    assert len(rows) == 80 and all((r.split is None) == (r.y is None) for r in rows)
