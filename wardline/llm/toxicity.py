"""Toxicity: a support vector machine over a gapped subsequence string kernel, with Nyström landmarks.

The kernel compares two strings by their common subsequences of three characters that lie within a
short span, each weighted by decay**span, so inserted or left-out characters cost a little only. A
sentence is judged by its worst word and a text by its three worst; one that is toxic beyond doubt suffices.
Words typical of toxic texts are learned with characters inserted, doubled and put around them, too. The
landmarks' weights fold into one weight for each subsequence, hence scoring a word does not depend on the number of landmarks.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Collection
from heapq import nlargest
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.svm import calibrate, dual_coordinate_descent, logistic
from wardline.llm.tables import labelled_sample

#: Labelled rows of either class that a fit reads at most; the keys' hashes choose them.
SAMPLE = 4_000
LANDMARKS, COST = 400, 0.5
SPAN, DECAY = 6, 0.7
#: Evidence (twice the log-likelihood ratio of a word's counts in toxic and clean texts) of a word that may be a
#: witness, that is one where the machine has not seen it, and that is one in any case.
MAYBE, LIKELY, SURE = 2.0, 6.0, 12.0
#: A decision from which a word is toxic beyond doubt, and the bounds within which decisions count.
CERTAIN, LOWEST, HIGHEST = 1.0, -1.0, 3.0
#: Longest piece of a word that is weighed at once; longer ones are weighed in overlapping pieces.
PIECE = 24

#: Characters often written for letters.
LOOKALIKES = dict(zip("013457@$", "oieastas"))
_STRIP = ".,;:!?\"'()[]{}<>#%&*|-_~`+=/\\"
_INSIDE = re.compile(r"[^\W_][\W_]+[^\W_]")
_NO_LETTER = re.compile(r"[\W_]+")
_SPACED = re.compile(r"(?<!\S)[^\W\d_](?:[\s.*_-]{1,2}[^\W\d_]){3,}(?!\S)")
_PLACES = [(j, k) for k in range(2, SPAN) for j in range(1, k)] + [
    (i, j, k) for k in range(3, SPAN) for j in range(2, k) for i in range(1, j)]
#: Ids of subsequences: three characters have their own, four are hashed behind them.
IDS = 1 << 19


def _code_table() -> np.ndarray:
    points = np.arange(0x110000)
    table = (28 + points % 36).astype(np.int64)  # nothing is 0, the boundary 27
    table[97:123] = np.arange(1, 27)
    for c, letter in LOOKALIKES.items():
        table[ord(c)] = ord(letter) - 96
    table[1], table[0] = 27, 0
    return table


_CODES = _code_table()


def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All words' character codes one after the other, a boundary on either side of each; each code's word."""
    text = "".join(f"\1{w}\1" for w in words)
    codes = _CODES[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    return codes, np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])


def subsequences(words: list[str]):
    """For each pattern of places: the word, id and weight of its subsequences.

    A word's weights are divided by the root of the sum of their squares, which its length decides.
    """
    codes, word = encode(words)
    sizes = np.bincount(word, minlength=len(words))
    square = np.zeros(len(words))
    for places in _PLACES:
        square += np.maximum(sizes - places[-1], 0) * DECAY ** (2 * places[-1] + 2)
    scale = 1 / np.sqrt(np.maximum(square, 1e-12))
    for places in _PLACES:
        k = places[-1]
        inside = np.flatnonzero(word[:-k] == word[k:]) if len(word) > k else np.zeros(0, np.int64)
        name = codes[inside]
        for p in places:
            name = name << 6 | codes[inside + p]
        if len(places) == 3:
            name = (1 << 18) + (name * 0x9E3779B1 >> 13 & (1 << 18) - 1)
        yield word[inside], name, DECAY ** (k + 1) * scale[word[inside]]


def kernel(words: list[str], others: list[str]) -> np.ndarray:
    """Normalised kernel of each pair."""
    parts = [np.concatenate(x) for x in zip(*subsequences(others))]
    known, at = np.unique(parts[1], return_inverse=True)
    dense = np.zeros((len(known) + 1, len(others)), np.float32)
    np.add.at(dense, (at, parts[0]), parts[2])
    place = np.full(IDS, len(known))
    place[known] = np.arange(len(known))
    out = np.zeros((len(words), len(others)))
    for a in range(0, len(words), 256):
        some = words[a : a + 256]
        for word, name, weight in subsequences(some):
            if len(word):
                first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
                rows = dense[place[name]] * weight[:, None].astype(np.float32)
                out[a + word[first]] += np.add.reduceat(rows, first, axis=0)
    return out


def units(text: str | None) -> set[str]:
    """The distinct pieces that a text is judged by: lower-case words without outer punctuation, those with
    inner punctuation also without it, long ones in overlapping pieces, and runs of single letters joined."""
    if not text:
        return set()
    text = text.lower()
    out = {w.strip(_STRIP) for w in set(text.split())}
    out.update([_NO_LETTER.sub("", w) for w in out if _INSIDE.search(w)])
    out.update("".join(c for c in m[0] if c.isalpha()) for m in _SPACED.finditer(text))
    for w in [w for w in out if len(w) > PIECE]:
        out.discard(w)
        out.update(w[i : i + PIECE] for i in range(0, len(w) - PIECE // 2, PIECE // 2))
    out.discard("")
    return out


#: A text's score reads its worst words, this many.
WORST = 3


class ToxicityModel(NamedTuple):
    weights: np.ndarray  # by subsequence
    bias: float
    slopes: np.ndarray   # of the evidence in the worst words' decisions
    offset: float

    def decide(self, words: list[str]) -> np.ndarray:
        out = np.full(len(words), self.bias)
        for a in range(0, len(words), 4096):
            some = words[a : a + 4096]
            for word, name, weight in subsequences(some):
                out[a : a + len(some)] += np.bincount(word, self.weights[name] * weight, minlength=len(some))
        return out

    def score(self, worst: np.ndarray) -> np.ndarray:
        return logistic(evidence(worst) @ self.slopes + self.offset)


def worst_of(decisions) -> list[float]:
    """The highest decisions in order, within bounds; a text of fewer words is filled up with the lowest."""
    return ([min(max(d, LOWEST), HIGHEST) for d in nlargest(WORST, decisions)] + [LOWEST] * WORST)[:WORST]


def evidence(worst: np.ndarray) -> np.ndarray:
    """The worst decisions up to certainty, and how far the first is beyond it."""
    return np.c_[np.minimum(worst, CERTAIN), np.maximum(worst[:, 0] - CERTAIN, 0)]


def altered(word: str) -> list[str]:
    """A word with a character inserted, one doubled, and some around it; the same for a word each time."""
    if len(word) < 4:
        return []
    h = zlib.crc32(word.encode())
    k = 1 + h % (len(word) - 1)
    return [word[:k] + chr(97 + h // 64 % 26) + word[k:], word[:k] + word[k - 1] + word[k:], f"x{word}x"]


def _fit_words(positive: dict[str, float], negative: dict[str, float], known: Collection[str], seed: int) -> tuple[np.ndarray, float]:
    """Landmarks from both classes, the Nyström map, the machine; folded to weights by subsequence."""
    rng = np.random.default_rng(seed)
    top = sorted((w for w in positive if w in known), key=lambda w: (-positive[w], w))[: LANDMARKS // 2]
    hard = sorted(negative, key=lambda w: (-negative[w], w))[: LANDMARKS // 4]
    rest = sorted(negative.keys() - set(hard))
    marks = top + hard + rng.choice(rest, min(LANDMARKS - len(top) - len(hard), len(rest)), replace=False).tolist()
    values, vectors = np.linalg.eigh(kernel(marks, marks))
    keep = values > 1e-6
    root = vectors[:, keep] / np.sqrt(values[keep])
    words = [*positive, *negative]
    mapped = kernel(words, marks) @ root
    every = np.arange(mapped.shape[1])
    y = np.array([1] * len(positive) + [-1] * len(negative))
    counts = np.array([*positive.values(), *negative.values()])
    inner, bias = dual_coordinate_descent([(every, x) for x in mapped], y, mapped.shape[1], cost=COST, rounds=40, counts=counts)
    beta = root @ inner
    table = np.zeros(IDS)
    for mark, name, weight in subsequences(marks):
        np.add.at(table, name, weight * beta[mark])
    return table, bias


def fit_rows(toxic: list[set[str]], clean: list[set[str]], rounds: int = 3, seed: int = 5) -> ToxicityModel:
    """The fit to the units of toxic and clean texts, neither list empty; no text without units."""
    seen = Counter(w for r in toxic for w in r), Counter(w for r in clean for w in r)
    sizes = len(toxic), len(clean)

    def typical(w: str) -> float:
        a, b = seen[0][w], seen[1][w]
        if a * sizes[1] <= b * sizes[0]:
            return 0.0
        mean = (a + b) / sum(sizes)
        return 2 * (a * np.log(a / sizes[0] / mean) + (b * np.log(b / sizes[1] / mean) if b else 0.0))

    signs = {w: typical(w) for w in seen[0]}
    every = sorted(seen[0].keys() | seen[1].keys())
    pool = sorted(w for w in seen[1] if signs.get(w, 0.0) < MAYBE)  # a word typical of toxic texts is no clean one

    def witnesses(rank: dict[str, float]) -> dict[str, float]:
        out: Counter = Counter()
        for r in toxic:
            best = sorted((w for w in r if signs[w] >= MAYBE), key=lambda w: (-rank.get(w, signs[w]), w))[:WORST]
            out.update({w for w in r if signs[w] >= SURE} | {w for w in best if signs[w] >= LIKELY or rank.get(w, 0.0) > 0})
        found = {w: float(n) for w, n in out.items()}
        for w, n in out.items():
            if signs[w] >= SURE:
                for v in altered(w):
                    found.setdefault(v, n / 3)
        return dict(sorted(found.items()))  # whatever the order of the sets

    positive = witnesses({}) or {max(r, key=lambda w: (signs[w], w)): 1.0 for r in toxic}
    rng = np.random.default_rng(seed)
    negative = dict.fromkeys(rng.choice(pool, min(4_000, len(pool)), replace=False).tolist(), 1.0) if pool else {}
    for step in range(rounds):
        weights, bias = _fit_words(positive, negative, seen[0].keys(), seed + step)
        model = ToxicityModel(weights, bias, np.ones(WORST + 1), 0.0)
        rank = dict(zip(every, model.decide(every).tolist()))
        positive = witnesses(rank) or positive
        for w in sorted(pool, key=lambda w: (-rank[w], w))[:1_500]:
            negative[w] = float(min(seen[1][w], 20))
    rows = [worst_of(rank[w] for w in r) for r in toxic + clean]
    # The sentence of a witness beyond doubt is toxic alone.
    alone = [[w[0], *[LOWEST] * (WORST - 1)] for w in rows[: len(toxic)] if w[0] > CERTAIN]
    labels = np.array([1] * len(toxic) + [0] * len(clean) + [1] * len(alone))
    return ToxicityModel(weights, bias, *_rising(evidence(np.array(rows + alone)), labels))


def _rising(features: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """A calibration in which no evidence speaks against the label."""
    keep = np.arange(features.shape[1])
    while True:
        slopes, offset = calibrate(features[:, keep], labels)
        if (slopes >= 0).all():
            out = np.zeros(features.shape[1])
            out[keep] = slopes
            return out, offset
        keep = keep[slopes >= 0]


def _sets(column: pa.ChunkedArray) -> list[set[str]]:
    """The units of texts that have any; equal words are one object."""
    lists = column.combine_chunks()
    words = lists.flatten().dictionary_encode()
    names, at, ends = words.dictionary.to_pylist(), words.indices.to_pylist(), np.cumsum(np.diff(lists.offsets.to_numpy())).tolist()
    return [{names[k] for k in at[a:b]} for a, b in zip([0, *ends], ends) if b > a]


def fit_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
                 sample: int = SAMPLE, rounds: int = 3, seed: int = 5) -> ToxicityModel:
    """Fits on the texts of at most ``sample`` rows of either label (0 or 1) in ``labels(key, label)``.

    A toxic text is known to hold at least one toxic sentence, not which. Its witnesses are at first the
    words most typical of toxic texts, by the evidence in their counts, then also those the machine ranks worst; clean
    texts give random words and those the machine ranks worst. Without labels of both classes every text scores the same.
    """
    @F.arrow_udf("array<string>")
    def pieces(column: pa.Array) -> pa.Array:
        return pa.array([sorted(units(t)) for t in column.to_pylist()], pa.list_(pa.string()))

    found = [labelled_sample(docs, labels.where(F.col(label) == y), key, text, label, sample)
             .select("spread", "key", pieces("text").alias("units")).toArrow().sort_by([("spread", "ascending"), ("key", "ascending")])["units"]
             for y in (1, 0)]
    toxic, clean = map(_sets, found)
    if not toxic or not clean:
        known = np.array([1] * len(toxic) + [0] * len(clean))
        return ToxicityModel(np.zeros(IDS), 0.0, np.zeros(WORST + 1), calibrate(np.zeros(len(known)), known)[1])
    return fit_rows(toxic, clean, rounds, seed)


def toxicity_score(text: Column, model: ToxicityModel, remembered: int = 300_000) -> Column:
    """Score of the label being 1, from 0 to 1, of each whole text; null and empty texts have no toxic word.

    ``remembered``: words whose decision a task keeps, so that a common word is weighed once.
    """

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        known = _memory(model)
        out = np.empty((len(column), WORST))
        rows: list[set] = []

        def flush(end):
            new = set().union(*rows) - known.keys()
            if len(known) + len(new) > remembered:
                known.clear()
                new = set().union(*rows)
            new = list(new)
            known.update(zip(new, model.decide(new).tolist()))
            for k, r in enumerate(rows):
                out[end - len(rows) + k] = worst_of(map(known.__getitem__, r))

        held = 0
        for k in range(len(column)):
            rows.append(units(column[k].as_py()))
            held += len(rows[-1])
            if held > 50_000:
                flush(k + 1)
                rows, held = [], 0
        flush(len(column))
        return pa.array(model.score(out))

    return score(text)


_KNOWN: dict[bytes, dict] = {}


def _memory(model: ToxicityModel) -> dict[str, float]:
    """The decisions of this worker's last model."""
    name = np.float64(model.bias).tobytes() + model.weights[:: 1 << 6].tobytes()
    if name not in _KNOWN:
        _KNOWN.clear()
        _KNOWN[name] = {}
    return _KNOWN[name]
