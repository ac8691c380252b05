"""Merged column summaries against one pass and against the exact operators."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardline.operators import profile, summaries

COLUMNS = ["whole", "wide", "offset", "text", "gaps", "none", "same"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(13)
    out = [(k, k % 97, rng.lognormvariate(0, 2), 1e9 + rng.random(), f"t{rng.randrange(3000)}", rng.choice([None, 1.5, 2.5]), None, 4) for k in range(20_000)]
    return spark.createDataFrame(out, "id long, whole int, wide double, offset double, text string, gaps double, none double, same int").cache()


@pytest.fixture(scope="module")
def merged(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("summaries"))
    for k, low in enumerate([0, 100, 100, 9_000]):  # one batch is empty
        high = [100, 100, 9_000, 20_000][k]
        summaries.store_summary(summaries.summarise(rows.where((F.col("id") >= low) & (F.col("id") < high)), COLUMNS), path, f"b{k}")
    summaries.store_summary(summaries.summarise(rows.where("id < 100"), COLUMNS), path, "b0")  # again
    return summaries.merge(summaries.stored_summaries(spark, path)).cache()


def test_merged_equals_one_pass(rows, merged):
    one = {r["column"]: r for r in summaries.profile(summaries.summarise(rows, COLUMNS)).collect()}
    got = {r["column"]: r for r in summaries.profile(merged).collect()}
    assert set(one) == set(got) == set(COLUMNS)
    for c in COLUMNS:
        a, b = one[c], got[c]
        assert (a.n, a.missing_count, a.missing_pct, a.min, a["max"]) == (b.n, b.missing_count, b.missing_pct, b.min, b["max"])
        assert a["mean"] == pytest.approx(b["mean"], rel=1e-12) if a["mean"] is not None else b["mean"] is None
        assert a["std"] == pytest.approx(b["std"], rel=1e-6) if a["std"] is not None else b["std"] is None
        assert abs(a.n_distinct - b.n_distinct) <= 0.02 * a.n_distinct


def test_errors_against_the_exact_operators(rows, merged):
    got = {r["column"]: r for r in summaries.profile(merged).collect()}
    gaps = {r["column"]: r.missing_count for r in profile.null_profile(rows, COLUMNS).collect()}
    exact = {r["column"]: r.n_distinct for r in profile.distinct_counts(rows, ["whole", "wide", "offset", "text"]).collect()}
    described = {r["column"]: r for r in profile.describe(rows, ["whole", "wide", "offset", "text"]).collect()}
    for c, n in exact.items():
        assert abs(got[c].n_distinct - n) <= 0.04 * n
    for c in COLUMNS:
        assert got[c].missing_count == gaps[c]
    for c in ("whole", "wide", "offset"):
        assert got[c]["mean"] == pytest.approx(described[c]["mean"], rel=1e-9) and got[c]["std"] == pytest.approx(described[c]["std"], rel=1e-6)
        values = np.array([r[0] for r in rows.select(c).collect()], float)
        for q, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
            low, high = (values < got[c][name]).mean(), (values <= got[c][name]).mean()
            assert low - 0.01 <= q <= high + 0.01
    assert got["none"]["mean"] is None and got["none"].n_distinct == 0 and got["same"]["std"] == 0


def test_histograms_add_up_and_are_close(rows, merged):
    bins = summaries.histogram(merged, 10).collect()
    values = {c: np.array([r[0] for r in rows.select(c).where(F.col(c).isNotNull()).collect()], float) for c in ("whole", "offset", "gaps", "same")}
    for c, v in values.items():
        mine = sorted((r for r in bins if r["column"] == c), key=lambda r: r.bin)
        assert sum(r.n for r in mine) == len(v) and len(mine) == 10
        if c != "same":
            want = np.histogram(v, 10)[0]
            assert max(abs(r.n - w) for r, w in zip(mine, want)) <= 0.02 * len(v)
    assert not [r for r in bins if r["column"] in ("text", "none")]


def test_nothing_at_all(rows):
    empty = summaries.summarise(rows.limit(0), ["whole", "text"])
    got = {r["column"]: r for r in summaries.profile(summaries.merge(empty.unionByName(empty))).collect()}
    assert [(r.n, r.missing_count, r.missing_pct, r.n_distinct, r["mean"], r.p50) for r in got.values()] == [(0, 0, 0.0, 0, None, None)] * 2
    assert summaries.histogram(summaries.merge(empty), 5).count() == 0
