"""Quality and toxicity: held-out accuracy, solvers, and inputs without labels or words."""

import random
import re
import string

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.compare import duck
from wardline.llm import queries
from wardline.llm.quality import SIZE, fit_quality, quality_score, scaled, word_ngrams
from wardline.llm.svm import calibrate, dual_coordinate_descent
from wardline.llm.tables import documents, table
from wardline.llm import toxicity
from wardline.llm.toxicity import fit_rows, fit_toxicity, kernel, toxicity_score, units, worst_of

MIDDLE = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name, label, least", [("op8_quality", "quality", 0.95), ("op3_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    rows = queries.QUERIES[name](spark, MIDDLE).join(table(spark, MIDDLE, "labels"), "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r[label] for r in rows]) >= least
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def plain_ngrams(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)))
    return {tuple(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)}


def invented(rng, letters, n):
    return ["".join(rng.choice(letters) for _ in range(5)) for _ in range(n)]


def test_texts_that_only_their_words_tell_apart(spark):
    """Same shapes, different words."""
    rng = random.Random(6)
    kinds = invented(rng, "abcdefgh", 150), invented(rng, "stuvwxyz", 150)
    rows = [(k, " ".join(rng.choice(kinds[k % 2]) for _ in range(60)), k % 2) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, quality int")
    model = fit_quality(docs.select("doc_id", "text"), docs.where("doc_id < 400").select("doc_id", "quality"))
    got = docs.where("doc_id >= 400").select("quality", quality_score(F.col("text"), model).alias("s")).collect()
    assert np.mean([(r.s >= 0.7) == r.quality for r in got]) >= 0.95
    shapes = fit_quality(docs.select("doc_id", "text"), docs.where("doc_id < 400").select("doc_id", "quality"), vocabulary=0)
    blind = docs.where("doc_id >= 400").select("quality", quality_score(F.col("text"), shapes).alias("s")).collect()
    assert len(shapes.vocabulary) == 0 and np.mean([(r.s >= 0.7) == r.quality for r in blind]) < 0.7


def test_phrases_are_learned(spark):
    """The same words, in other order."""
    rng = random.Random(7)
    filler = invented(rng, "abcdefgh", 60)
    rows = [(k, " ".join(rng.choice(filler) for _ in range(20)) + (" click now here" if k % 2 else " here now click") + " " + rng.choice(filler), 1 - k % 2) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, quality int")
    model = fit_quality(docs.select("doc_id", "text"), docs.where("doc_id < 300").select("doc_id", "quality"))
    got = docs.where("doc_id >= 300").select("quality", quality_score(F.col("text"), model).alias("s")).collect()
    assert np.mean([(r.s >= 0.5) == r.quality for r in got]) >= 0.95


def test_ngrams_are_those_of_the_words():
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["A", "b", "é", "東京", "x9"]) for _ in range(rng.randrange(12))) for _ in range(40)] + ["", None, " \t"]
    names = {}
    for i, j, doc, gram in word_ngrams(pa.array(texts)):
        for k in range(i, j):
            mine = sorted(set(gram[doc == k - i].tolist()))
            assert len(mine) == len(plain_ngrams(texts[k]))
            for other, theirs in names.items():
                assert len(set(mine) & set(theirs)) == len(plain_ngrams(texts[k]) & plain_ngrams(texts[other]))
            names[k] = mine


def test_ratios_and_weights_against_a_plain_version():
    rng = np.random.default_rng(9)
    at = [np.sort(np.concatenate([rng.choice(50, 8, replace=False), SIZE + rng.choice(30, rng.integers(0, 6), replace=False)])) for _ in range(80)]
    y = np.array([int(SIZE + 3 in x or 7 in x) for x in at])
    used = np.arange(60)
    ratio, values = scaled(at, y, used, SIZE + 30, 1.0)
    for lo, hi in ((0, SIZE), (SIZE, SIZE + 30)):
        plain = [[1.0 + sum(f in at[k] for k in used if y[k] == c) for f in range(lo, min(hi, lo + 50))] for c in (0, 1)]
        rest = hi - lo - len(plain[0])
        want = [np.log(p / (sum(plain[1]) + rest)) - np.log(q / (sum(plain[0]) + rest)) for q, p in zip(*plain)]
        assert np.allclose(ratio[lo : lo + len(want)], want)
    for k, x in enumerate(at):
        n = (x < SIZE).sum()
        assert np.allclose(values[k], [ratio[f] / np.sqrt(n if f < SIZE else len(x) - n) for f in x])
    # The dual optimum: weights are sums of examples, and every example meets the conditions of the hinge loss.
    w, b = dual_coordinate_descent([(at[k], values[k]) for k in used], 2 * y[used] - 1, SIZE + 30, rounds=2000)
    signs = 2 * y[used] - 1
    share = len(used) / (2 * np.array([(signs == s).sum() for s in signs]))
    def loss(weights, bias):
        margins = np.array([weights[at[k]] @ values[k] + bias for k in used])
        return 0.5 * (weights @ weights + bias * bias) + (share * np.maximum(0, 1 - signs * margins)).sum()
    best = loss(w, b)
    for _ in range(200):
        moved = np.zeros(SIZE + 30)
        moved[rng.choice(np.unique(np.concatenate(at)), 5)] = rng.normal(size=5) * 0.01
        assert loss(w + moved, b + rng.normal() * 0.01) >= best - 1e-6


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, labels = documents(spark, MIDDLE), table(spark, MIDDLE, "labels")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    a = fit_quality(docs.where(~held), labels.where(~held))
    b = fit_quality(docs, labels.where(~held))
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_dual_coordinate_descent_parts_what_can_be_parted():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 3))
    y = np.where(x[:, 0] - 2 * x[:, 1] > 0.1, 1, -1)
    keep = abs(x[:, 0] - 2 * x[:, 1] - 0.1) > 0.2
    w, b = dual_coordinate_descent([(np.arange(3), v) for v in x[keep]], y[keep], 3, cost=50.0, rounds=200)
    assert ((x[keep] @ w + b > 0) == (y[keep] > 0)).all()
    assert dual_coordinate_descent([], np.zeros(0), 2)[1] == 0.0
    assert dual_coordinate_descent([(np.array([0]), np.array([1.0]))], np.array([-1]), 2)[1] == -1.0


def test_calibration_rises_with_the_margin():
    slopes, offset = calibrate(np.array([-2.0, -1, -1, 1, 1, 2]), np.array([0, 0, 0, 1, 1, 1]))
    assert slopes[0] > 0 and abs(offset) < 1


def brute_kernel(a, b):
    from wardline.llm.toxicity import DECAY, SPAN, encode

    def parts(w):
        codes = encode([w])[0].tolist()
        out, square = {}, 0.0
        for i in range(len(codes)):
            for k in range(i + 2, min(len(codes), i + SPAN)):
                inner = range(i + 1, k)
                for mid in [(j,) for j in inner] + [(j, m) for j in inner for m in inner if j < m]:
                    name = tuple(codes[p] for p in (i, *mid, k))
                    out[name] = out.get(name, 0) + DECAY ** (k - i + 1)
                    square += DECAY ** (2 * (k - i + 1))
        return out, square ** 0.5
    (x, n), (y, m) = parts(a), parts(b)
    return sum(v * y.get(k, 0) for k, v in x.items()) / (n * m)


def test_kernel_is_the_gapped_subsequence_kernel():
    words = ["idiot", "id-iot", "i.d.i.o.t", "station", "aa", "x"]
    got = kernel(words, ["idiot", "station"])
    for i, w in enumerate(words):
        for j, o in enumerate(["idiot", "station"]):
            assert got[i, j] == pytest.approx(brute_kernel(w, o), abs=1e-5)
    assert got[1, 0] > 3 * got[1, 1] and got[2, 0] > got[3, 0]


def test_units():
    assert units("an i-d-i-o-t, re-tell") == {"an", "i-d-i-o-t", "idiot", "re-tell", "retell"}
    assert units(None) == units("") == set() and units("You, (Idiot)!") == {"you", "idiot"}
    assert "idiot" in units("an i d i o t speaks") and max(map(len, units("a" * 1000))) <= 24


def test_gapped_insults_are_caught(spark):
    rows = [(i, f"you are {'an idiot and a moron' if i % 2 else 'a friend and a neighbour'} of number{i}", i % 2) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, toxic int")
    model = fit_toxicity(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    asked = spark.createDataFrame([("such an id-iot and m.oron",), ("such a kind neighbour",), (None,), ("",)], "text string")
    bad, good, *none = [r.s for r in asked.select(toxicity_score(F.col("text"), model).alias("s")).collect()]
    assert bad > 0.5 > good and none[0] == none[1] < 0.5


@pytest.mark.parametrize("folder, least", [(MIDDLE, 0.7), ("/root/testdata/sf0.1", 0.85)])
def test_toxic_texts_are_found_and_others_left_alone(spark, folder, least):
    """Some thirty and three hundred toxic texts to learn from, of four languages."""
    rows = queries.op3_toxicity(spark, folder).join(table(spark, folder, "labels"), "doc_id").where("held_out").collect()
    caught = [r.toxic for r in rows if r.predicted]
    assert sum(caught) >= least * sum(r.toxic for r in rows) and sum(caught) >= 0.85 * len(caught)


@pytest.fixture(scope="module")
def toxic_model():
    """Learned from some thirty toxic texts."""
    def rows(y):
        found = duck(MIDDLE).execute("SELECT text FROM documents JOIN labels USING (doc_id) WHERE toxic = ? ORDER BY doc_id", [y]).fetchall()
        return [u for (t,) in found[: 30 if y else 300] if (u := units(t))]
    return fit_rows(rows(1), rows(0))


def scores(model, *texts):
    found = [units(t) for t in texts]
    return model.score(np.array([worst_of(model.decide(sorted(u)).tolist()) for u in found]))


@pytest.mark.parametrize("insult, least", [("idiot", 0.7), ("trash", 0.7), ("worthless", 0.5)])
def test_one_insult_suffices_however_it_is_written(toxic_model, insult, least):
    """Seven to thirteen of the thirty texts have each."""
    ways = [insult, insult.upper(), insult + "!!", "-".join(insult), " ".join(insult), insult[:2] + "-" + insult[2:], insult[:3] + "." + insult[3:],
            insult[:2] + insult[1:], insult.replace("i", "1").replace("s", "$"), f"({insult})"]
    assert (scores(toxic_model, *[f"there was such {w} in here" for w in ways]) >= least).all()
    around = toxic_model.decide([f"x{insult}x", insult[:2] + "q" + insult[2:], "station", "the"])
    assert around[:2].min() > 0 > around[2:].max()


def test_clean_texts_score_low(toxic_model):
    assert (scores(toxic_model, "", "the and of", "a station of this nation", "the trains crown the clouds") < 0.3).all()


def test_folded_weights_are_those_of_the_landmarks(monkeypatch):
    """A plain machine: the sum over landmarks of their weights times the kernel."""
    seen = {}
    plain = toxicity.kernel
    def noted(words, others):
        seen["marks"] = others
        return plain(words, others)
    monkeypatch.setattr(toxicity, "kernel", noted)
    kept = {}
    solve = toxicity.dual_coordinate_descent
    def solved(rows, *args, **named):
        kept["inner"] = solve(rows, *args, **named)
        return kept["inner"]
    monkeypatch.setattr(toxicity, "dual_coordinate_descent", solved)
    words = {"idiot": 3.0, "idiots": 1.0, "moron": 2.0}, {w: 1.0 for w in ("station", "motor", "neighbour", "friend", "idea", "the")}
    weights, bias = toxicity._fit_words(*words, {"idiot", "idiots", "moron"}, 1)
    marks = seen["marks"]
    gram = np.array([[brute_kernel(a, b) for b in marks] for a in marks])
    values, vectors = np.linalg.eigh(gram)
    keep = values > 1e-6
    root = vectors[:, keep] / np.sqrt(values[keep])
    asked = ["idiot", "id-iot", "nation", "m.o.r.o.n"]
    mapped = np.array([[brute_kernel(w, m) for m in marks] for w in asked]) @ root
    everything = np.array([[brute_kernel(w, m) for m in marks] for w in [*words[0], *words[1]]]) @ root
    y = np.array([1, 1, 1, *[-1] * 6])
    inner, plain_bias = solve([(np.arange(mapped.shape[1]), x) for x in everything], y, mapped.shape[1], cost=toxicity.COST, rounds=40,
                              counts=np.array([*words[0].values(), *words[1].values()]))
    got = toxicity.ToxicityModel(weights, bias, np.ones(4), 0.0).decide(asked)
    assert got == pytest.approx(mapped @ inner + plain_bias, abs=1e-2)


def test_counts_stand_for_repeated_rows():
    rng = np.random.default_rng(4)
    x, y, counts = rng.normal(size=(40, 3)), np.where(rng.random(40) < 0.3, 1, -1), rng.integers(1, 5, 40)
    rows = [(np.arange(3), v) for v in x]
    a = dual_coordinate_descent(rows, y, 3, rounds=400, counts=counts.astype(float))
    b = dual_coordinate_descent([r for r, n in zip(rows, counts) for _ in range(n)], np.repeat(y, counts), 3, rounds=400)
    assert np.allclose(a[0], b[0], atol=0.02) and abs(a[1] - b[1]) < 0.02


@pytest.mark.parametrize("fit, score, label", [(fit_quality, quality_score, "quality"), (fit_toxicity, toxicity_score, "toxic")])
def test_without_labels_or_rows(spark, edge, nothing, fit, score, label):
    empty = spark.createDataFrame([], f"doc_id bigint, {label} int")
    one_sided = spark.createDataFrame([(1, 1), (5, 1), (5, None), (None, 1)], f"doc_id bigint, {label} int")
    for labels in (empty, one_sided):
        model = fit(edge, labels)
        rows = edge.select(score(F.col("text"), model).alias("s")).collect()
        assert len({r.s for r in rows}) == 1 and 0 <= rows[0].s <= 1
    assert nothing.select(score(F.col("text"), fit(nothing, one_sided)).alias("s")).count() == 0
