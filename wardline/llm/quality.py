"""Quality classifier: a linear hinge-loss fit over n-gram indicators scaled by class log-count ratios.

N-grams run over one to three consecutive words, and over their shapes: a shape is a word with letters,
capitals and digits collapsed to one sign each, and a mark if it repeats the word before. An indicator
says that an n-gram occurs; for one of shapes others say that it makes up a twentieth, or a third of its text. Of the
n-grams of words those count that enough labelled texts have, and of them the ones that tell the classes apart best.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.svm import calibrate, dual_coordinate_descent, logistic
from wardline.llm.tables import labelled_sample
from wardline.llm.words import WordHasher, mix, signed, slices
from wardline.session import staged

BUCKETS = 1 << 14
LEVELS = (0.0, 0.05, 1 / 3)
SIZE = BUCKETS * len(LEVELS)
#: Labelled rows a fit reads at most, those of the smallest key hashes.
SAMPLE = 12_000
#: N-grams of words in a model at most, and labelled texts that one must be in.
VOCABULARY, LEAST = 50_000, 5

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[48:58], _SHAPE[65:91], _SHAPE[97:123], _SHAPE[128:] = 48, 65, 97, 97


def ngram_counts(column: pa.Array):
    """For each slice of rows: first row, and its rows' counts by n-gram bucket with their word counts."""
    plain, shape = WordHasher(3, fold=True), WordHasher(4)
    for i, j, data, offsets in slices(column):
        words = plain.words(data, offsets)
        n, rows = len(words.hash), j - i
        if not n:
            yield i, np.zeros((rows, BUCKETS), np.uint32), np.zeros(rows, np.int64)
            continue
        signs = _SHAPE[data]
        keep = np.ones(len(data), bool)
        keep[1:] = signs[1:] != signs[:-1]
        keep[words.start] = True
        place = np.concatenate([[0], np.cumsum(keep)])
        forms = shape.words(signs[keep], place[offsets]).hash
        same = np.zeros(n, bool)
        same[1:] = (words.hash[1:] == words.hash[:-1]) & (words.doc[1:] == words.doc[:-1])
        forms = np.where(same, forms * np.uint64(3), forms)
        docs, buckets, run = [], [], forms
        for k in range(3):
            if k:
                run = mix(run[:-1] * np.uint64(0x9E3779B97F4A7C15) + forms[k:])
            inside = words.doc[: n - k] == words.doc[k:]
            docs.append(words.doc[: n - k][inside])
            buckets.append((mix(run + np.uint64(k)) & np.uint64(BUCKETS - 1)).astype(np.int64)[inside])
        for a in range(0, rows, 128):  # a counting table of bounded size at a time
            b = min(a + 128, rows)
            cells = [d[m] * BUCKETS + g[m] - a * BUCKETS for d, g in zip(docs, buckets) for m in [(d >= a) & (d < b)]]
            counts = np.bincount(np.concatenate(cells), minlength=(b - a) * BUCKETS).reshape(b - a, BUCKETS)
            yield i + a, counts, np.bincount(words.doc, minlength=rows)[a:b]


def indicators(column: pa.Array):
    """Row and sorted indicator indices of every text."""
    for first, counts, sizes in ngram_counts(column):
        row, bucket = np.nonzero(counts)
        rate = counts[row, bucket] / np.maximum(sizes[row], 1)
        for k in range(len(counts)):
            a, b = np.searchsorted(row, [k, k + 1])
            yield first + k, np.concatenate([bucket[a:b][rate[a:b] > level] + BUCKETS * n for n, level in enumerate(LEVELS)])


def word_ngrams(column: pa.Array):
    """For each slice of rows: first row, past-last row, and the rows and 64-bit hashes of all n-grams of words."""
    hasher = WordHasher(3, fold=True)
    for i, j, data, offsets in slices(column):
        words = hasher.words(data, offsets)
        n, run, docs, grams = len(words.hash), words.hash, [], []
        for k in range(min(3, n)):
            if k:
                run = mix(run[:-1] * np.uint64(0x9E3779B97F4A7C15) + words.hash[k:])
            inside = words.doc[: n - k] == words.doc[k:]
            docs.append(words.doc[: n - k][inside])
            grams.append(run[inside] + np.uint64(k))
        yield i, j, np.concatenate(docs or [np.zeros(0, np.int64)]), np.concatenate(grams or [np.zeros(0, np.uint64)])


def known_ngrams(column: pa.Array, vocabulary: np.ndarray):
    """For each slice of rows: first row, past-last row, and each row's distinct n-grams as places in the ascending vocabulary."""
    for i, j, doc, gram in word_ngrams(column):
        if not len(vocabulary) or not len(gram):
            yield i, j, np.zeros(0, np.int64), np.zeros(0, np.int64)
            continue
        place = np.minimum(np.searchsorted(vocabulary, gram), len(vocabulary) - 1)
        hit = vocabulary[place] == gram
        cell = np.unique(doc[hit] * len(vocabulary) + place[hit])
        yield i, j, cell // len(vocabulary), cell % len(vocabulary)


class QualityModel(NamedTuple):
    weights: np.ndarray     # of indicators of shapes, then of the vocabulary
    bias: float
    slope: float
    offset: float
    vocabulary: np.ndarray  # ascending

    def margins(self, column: pa.Array) -> np.ndarray:
        out = np.full(len(column), self.bias)
        for first, counts, sizes in ngram_counts(column):
            row, bucket = np.nonzero(counts)
            rate = counts[row, bucket] / np.maximum(sizes[row], 1)
            total, active = np.zeros(len(counts)), np.zeros(len(counts))
            for n, level in enumerate(LEVELS):
                on = rate > level
                total += np.bincount(row[on], self.weights[bucket[on] + BUCKETS * n], minlength=len(counts))
                active += np.bincount(row[on], minlength=len(counts))
            out[first : first + len(counts)] += total / np.sqrt(np.maximum(active, 1))
        for i, j, doc, place in known_ngrams(column, self.vocabulary):
            active = np.bincount(doc, minlength=j - i)
            out[i:j] += np.bincount(doc, self.weights[SIZE + place], minlength=j - i) / np.sqrt(np.maximum(active, 1))
        return out


def _vocabulary(rows: DataFrame, most: int, least: int) -> np.ndarray:
    """The n-grams of words that tell the classes of ``rows(text, label)`` apart best, by the evidence in the numbers of texts."""
    def read(batches):
        for batch in batches:
            labels = batch.column(1).to_numpy()
            for i, _, doc, gram in word_ngrams(batch.column(0)):
                cell = np.unique(np.stack([doc.astype(np.uint64), gram]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(signed(cell[1])), pa.array(labels[i + cell[0].astype(np.int64)].astype(np.int32))], ["gram", "label"])

    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return np.zeros(0, np.uint64)
    counts = (rows.select("text", "label").mapInArrow(read, "gram bigint, label int").groupBy("gram")
              .agg(F.count_if(F.col("label") == 1).alias("a"), F.count_if(F.col("label") == 0).alias("b")).where(F.col("a") + F.col("b") >= least))
    mean = (F.col("a") + F.col("b")) / float(sum(sizes.values()))
    def part(n, size):
        return F.when(F.col(n) > 0, F.col(n) * F.log(F.col(n) / size / mean)).otherwise(0.0)
    best = counts.select("gram", (part("a", sizes[1]) + part("b", sizes[0])).alias("evidence")).orderBy(F.desc("evidence"), "gram").limit(most)
    return np.sort(np.array([r["gram"] for r in best.select("gram").collect()], np.int64).view(np.uint64))


def fit_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
                sample: int = SAMPLE, smoothing: float = 1.0, vocabulary: int = VOCABULARY, least: int = LEAST) -> QualityModel:
    """Fits on the texts of at most ``sample`` rows of ``labels(key, label)`` with label 0 or 1.

    Log-count ratios come from those rows' indicators; a fifth of the rows is kept for the calibration. At most
    ``vocabulary`` n-grams of words count, those in ``least`` or more of the rows.
    Without labels of both classes every text gets the same score.
    """
    rows = staged(labelled_sample(docs, labels, key, text, label, sample), "labelled")
    apart = F.pmod("spread", F.lit(5)) == 0 if rows.count() >= 50 else F.lit(False)
    rows = rows.withColumn("held", apart)
    known = _vocabulary(rows.where("not held"), vocabulary, least)

    def read(batches):
        for batch in batches:
            found = [[x] for _, x in indicators(batch.column(0))]
            for i, j, doc, place in known_ngrams(batch.column(0), known):
                for k, x in enumerate(np.split(place, np.searchsorted(doc, np.arange(1, j - i)))):
                    found[i + k].append(SIZE + x)
            yield pa.RecordBatch.from_arrays(
                [pa.array([np.concatenate(x).astype(np.int32) for x in found], pa.list_(pa.int32())), batch.column(1), batch.column(2), batch.column(3)],
                ["at", "label", "spread", "held"])

    got = (rows.select("text", "label", "spread", "held").mapInArrow(read, "at array<int>, label int, spread bigint, held boolean").toArrow()
           .sort_by([("spread", "ascending"), ("label", "ascending")]))
    at, y = [np.array(x, np.int64) for x in got["at"].to_pylist()], np.array(got["label"].to_pylist(), np.int64)
    held = np.array(got["held"].to_pylist(), bool)
    fit = np.flatnonzero(~held)
    ratio, values = scaled(at, y, fit, SIZE + len(known), smoothing)
    weights, bias = dual_coordinate_descent([(at[k], values[k]) for k in fit], 2 * y[fit] - 1, SIZE + len(known))
    check = np.flatnonzero(held) if held.any() else fit
    margin = np.array([weights[at[k]] @ values[k] + bias for k in check])
    slopes, offset = calibrate(margin.reshape(-1, 1), y[check])
    return QualityModel(ratio * weights, bias, float(slopes[0]), offset, known)


def scaled(at: list[np.ndarray], y: np.ndarray, used: np.ndarray, size: int, smoothing: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """Log-count ratio of every indicator over the rows ``used``, and the values of each row's: shapes and words each by
    the root of how many there are."""
    sums = np.full((2, size), smoothing)
    for k in used:
        sums[y[k], at[k]] += 1
    ratio = np.zeros(size)
    for a, b in ((0, SIZE), (SIZE, size)):
        if b > a:
            ratio[a:b] = np.log(sums[1, a:b] / sums[1, a:b].sum()) - np.log(sums[0, a:b] / sums[0, a:b].sum())
    values = []
    for x in at:
        words = int(np.searchsorted(x, SIZE))  # shapes come first
        root = np.sqrt(np.maximum(1, np.where(np.arange(len(x)) < words, words, len(x) - words)))
        values.append(ratio[x] / root)
    return ratio, values


def quality_score(text: Column, model: QualityModel) -> Column:
    """Score of the label being 1, from 0 to 1; null is scored as the empty text."""

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        return pa.array(logistic(model.slope * model.margins(column) + model.offset))

    return score(text)
