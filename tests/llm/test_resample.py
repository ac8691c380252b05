"""Importance resampling against SQL, and against features built as strings."""

import math
import random
import re
import zlib

import numpy as np
import pytest

from tests.compare import compare, duck
from wardline.llm import queries, resample
from wardline.llm.oracle import SQL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_features(text, most=2):
    words = WORD.findall((text or "").translate(FOLD))
    return words, [" ".join(words[i : i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)]


def test_query_matches_the_sql(spark, folder):
    name = "op11_importance_resampling"
    assert compare(queries.QUERIES[name](spark, folder), duck(folder), SQL[name]) == []


@pytest.mark.parametrize("block", [5, 40, 1 << 20])
@pytest.mark.parametrize("most", [1, 2, 3])
def test_features_of_joined_texts(monkeypatch, block, most):
    monkeypatch.setattr(resample, "BLOCK", block)
    rng = random.Random(block + most)
    texts = ["".join(rng.choice("aBc9 .,\n\x00é東ÿ") for _ in range(rng.randrange(120))) for _ in range(80)]
    texts += ["", "x" * 500 + " " + "É" * 300 + " end", " ", "one"]
    want = sorted((k, zlib.crc32(f.encode())) for k, t in enumerate(texts) for f in plain_features(t, most)[1])
    got = sorted((int(d), int(h)) for _, doc, crc in resample.features((t.encode() for t in texts), most) for d, h in zip(doc, crc))
    assert got == want


def test_checksums_combine_over_any_length():
    for size in (0, 1, 47, 48, 49, 500):
        a, b = b"first part ", bytes(range(65, 91)) * 20
        got = resample.combined(np.array([zlib.crc32(a)], np.uint32), np.array([zlib.crc32(b[:size])], np.uint32), np.array([size]))
        assert int(got[0]) == zlib.crc32(a + b[:size])


def brute(docs, target, least_words=20, share=25):
    counts = [[0] * 10_000, [0] * 10_000]
    for k, texts in enumerate(([t for _, t in docs], target)):
        for t in texts:
            for f in plain_features(t)[1]:
                counts[k][zlib.crc32(f.encode()) % 10_000] += 1
    s, t = map(sum, counts)
    gain = [math.floor(1000 * math.log((b + 1) * (s + 10_000) / ((a + 1) * (t + 10_000)))) for a, b in zip(*counts)]
    import hashlib

    rows = {}
    for key, text in docs:
        words, feats = plain_features(text)
        weight = sum(gain[zlib.crc32(f.encode()) % 10_000] for f in feats) // len(feats) if feats else 0
        h = int(hashlib.sha256(f"7:{key}".encode()).hexdigest()[:8], 16)
        rows[key] = (len(feats), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words))
    long = sorted((k for k, r in rows.items() if r[3] >= least_words), key=lambda k: (-rows[k][2], k))
    drawn = {k: i + 1 for i, k in enumerate(long[: share * len(long) // 100])}
    return {k: (*r[:3], drawn.get(k)) for k, r in rows.items()}


def test_draw_against_brute_force(spark):
    rng = random.Random(3)
    docs = [(k, " ".join(rng.choice(["alpha", "beta", "Gamma", "naïve", "x1", "z" * 60]) for _ in range(rng.randrange(60)))) for k in range(200)]
    target = ["alpha alpha naïve"] * 5
    got = resample.importance(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5),
                              spark.createDataFrame([(t,) for t in target], "text string")).collect()
    assert {r.doc_id: (r.n_features, r.weight, r.score, r["rank"]) for r in got} == brute(docs, target)


def test_resampled_rows_lean_towards_the_target(spark):
    docs = [(k, ("target words here " if k % 2 else "other things there ") * 10, "x") for k in range(400)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    rows = resample.resampled(df, spark.createDataFrame([("target words here",)] * 50, "text string")).collect()
    assert len(rows) == 100 and sum(r.doc_id % 2 for r in rows) > 80 and set(rows[0].asDict()) == {"doc_id", "text", "source"}


def test_edges(spark, edge, nothing):
    target = spark.createDataFrame([(None,), ("",), ("plain words",)], "text string")
    rows = resample.importance(edge, target).collect()
    assert len(rows) == edge.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert [(r.n_features, r.weight, r["rank"]) for r in by[2]] == [(0, 0, None)] and by[9][0].n_features == 0
    assert by[5][0].score == by[5][1].score and by[None][0].n_features == 15
    assert by[7][0].n_features == 59_999 and by[1][0].weight == 0
    assert resample.importance(nothing, target).count() == 0
    assert resample.importance(edge, target.limit(0)).count() == len(rows)
    some = resample.importance(edge, target, least_words=1, share=100).where("rank is not null")
    assert sorted(r["rank"] for r in some.collect()) == list(range(1, 9))
