"""Exact dedup, the shingle join and substring dedup against SQL and brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tests.compare import compare, duck
from wardline.llm import queries
from wardline.llm.chunks import LEAST, MOST, exact_groups, recipes
from wardline.llm.components import connected_components
from wardline.llm.oracle import SQL
from wardline.llm import parity
from wardline.llm.parity import bit_sketch, folded, near_groups, segment_keys, segments, sketch_bits
from wardline.llm.spans import without_repeats
from wardline.llm.words import WordHasher, slices, window_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", ["op4_ngram_jaccard", "op6_exact_dedup", "op9_substring_dedup"])
def test_queries_match_the_sql(spark, folder, name):
    assert compare(queries.QUERIES[name](spark, folder), duck(folder), SQL[name]) == []


def test_words_are_those_of_the_pattern():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab \t\n\x0béü.\x00") for _ in range(rng.randrange(60))) for _ in range(300)] + [None, ""]
    seen = {}
    hasher = WordHasher(5)
    for i, _, data, offsets in slices(pa.array(texts), 500):
        words = hasher.words(data, offsets)
        raw = data.tobytes()
        for d, a, b, h in zip(*words):
            seen.setdefault(i + int(d), []).append(raw[a:b].decode())
            assert len({h, int(hasher.words(np.frombuffer(raw[a:b], np.uint8), np.array([0, b - a])).hash[0])}) == 1
    assert all(seen.get(k, []) == WORD.findall(t or "") for k, t in enumerate(texts))


def test_windows_do_not_cross_texts():
    column = pa.array(["a b c", "d e", "a b c d"])
    _, _, data, offsets = next(slices(column))
    words = WordHasher(1).words(data, offsets)
    first, h = window_hashes(words, 3)
    assert words.doc[first].tolist() == [0, 2, 2] and h[0] == h[1] != h[2]


def test_chunks_give_the_text_back_and_move_with_it():
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh \n") for _ in range(60_000))
    found = recipes(pa.array([text, "zz" + text, "", None, text.upper()])).to_pylist()
    sizes = [c["size"] for c in found[0]["chunks"]]
    assert sum(sizes) == len(text) and max(sizes) <= MOST and min(sizes[:-1]) >= LEAST
    assert found[0] == found[4] and found[2] == found[3] and found[2]["chunks"] == []
    shared = {c["digest"] for c in found[0]["chunks"]} & {c["digest"] for c in found[1]["chunks"]}
    assert len(shared) >= len(sizes) - 3


def test_exact_edges(edge, nothing):
    rows = exact_groups(edge).collect()
    assert len(rows) == edge.count() and exact_groups(nothing).count() == 0
    by = {}
    for r in rows:
        by.setdefault(r.text_sha256, []).append(r)
    assert all(sum(r.kept for r in g) == 1 and {r.group_size for r in g} == {len(g)} for g in by.values())
    same = next(g for g in by.values() if {r.doc_id for r in g} == {5, 6})
    assert {r.keep_id for r in same} == {6}
    assert {r.keep_id for g in by.values() for r in g if r.doc_id in (1, 2)} == {2}
    assert {r.doc_id for r in by[hashlib.sha256(b"\t \n").hexdigest()]} == {9}


@pytest.mark.parametrize("percent", [60, 80, 85])
def test_similar_sets_share_a_segment(percent):
    rng = np.random.default_rng(percent)
    for n in [1, 2, 3, 5, 8, 13, 40, 150, 700]:
        for _ in range(15):
            a = rng.integers(0, 2**63, n, dtype=np.uint64)
            drop = rng.integers(0, n + 1)
            b = np.concatenate([a[drop:], rng.integers(0, 2**63, rng.integers(0, n + 1), dtype=np.uint64)])
            common = n - drop
            if len(b) and 100 * common >= percent * (n + len(b) - common):
                assert set(segment_keys(a, percent).tolist()) & set(segment_keys(b, percent).tolist()), (n, len(b), common)
    assert segments(85, 2) == (0, 1)


def family(seed, groups=12, size=6):
    """Texts with near copies of near copies, so that links form chains."""
    rng, out = random.Random(seed), []
    for _ in range(groups):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([3, 4, 9, 60, 200]))]
        for _ in range(size):
            out.append(" ".join(words))
            words = list(words)
            for _ in range(rng.randrange(3)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(5000)}"
    return out


def brute_components(texts, size, percent):
    sets = []
    for t in texts:
        w = WORD.findall(t.lower())
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a in range(len(texts)):
        for b in range(a):
            c = len(sets[a] & sets[b])
            if c and 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in range(len(texts))}


@pytest.mark.parametrize("percent", [40, 50, 60, 70])
def test_no_link_is_lost_at_low_percentages(percent):
    rng = np.random.default_rng(percent)
    for n in [3, 20, 90, 400]:
        for _ in range(30):
            a = rng.integers(0, 2**63, n, dtype=np.uint64)
            more = int(n * (100 / percent - 1) * rng.random())
            b = np.concatenate([a, rng.integers(0, 2**63, more, dtype=np.uint64)])
            if 100 * n >= percent * len(b):
                assert set(segment_keys(a, percent).tolist()) & set(segment_keys(b, percent).tolist()), (n, len(b))


def test_sketches_bound_the_difference_at_any_width():
    rng = np.random.default_rng(3)
    for n in (5, 300, 3000):
        a = rng.integers(0, 2**63, n, dtype=np.uint64)
        b = np.concatenate([a[n // 5 :], rng.integers(0, 2**63, n // 4, dtype=np.uint64)])
        differ = n // 5 + n // 4
        wide = [bit_sketch(x, 8192) for x in (a, b)]
        for bits in (256, 1024, 8192):
            x, y = (folded(w, bits // 8) for w in wide)
            assert (x == bit_sketch(a, bits)).all() and np.bitwise_count(x ^ y).sum() <= differ
    assert sketch_bits(1, 85, 8, (256, 1 << 17)) == 256 and sketch_bits(3000, 85, 8, (256, 1 << 17)) == 8192


def alike(n, words, share, seed=4):
    """Texts that have about ``share`` of one text's words each, so that all pairs are alike."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(words)]
    return [" ".join(w if rng.random() < share else f"n{k}_{i}" for i, w in enumerate(base)) for k in range(n)]


def test_pairs_below_the_threshold_are_sorted_out_by_their_sketches(spark, monkeypatch):
    """125,000 pairs of similarity 0.72, none of 0.8; sets are read for next to none of them."""
    asked = []
    plain = parity._verified
    monkeypatch.setattr(parity, "_verified", lambda rows, pairs, *rest: (asked.append(pairs.distinct().count()), plain(rows, pairs, *rest))[1])
    df = spark.createDataFrame(list(enumerate(alike(500, 1200, 0.915))), "doc_id int, text string").repartition(4)
    got = near_groups(df, size=1, percent=80).collect()
    assert {r.component_id for r in got} == set(range(500)) and sum(asked) < 2_500


def test_large_segments_are_cut_into_blocks(spark):
    texts = alike(60, 40, 0.97) + family(9)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_groups(df, size=2, percent=80, rounds=0, block=4).collect()}
    assert got == brute_components(texts, 2, 80)


@pytest.mark.parametrize("size, percent, rounds", [(4, 85, 1), (5, 80, 2), (3, 50, 2), (2, 60, 0)])
def test_components_match_brute_force(spark, size, percent, rounds):
    texts = family(size)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_groups(df, size=size, percent=percent, rounds=rounds).collect()}
    assert got == brute_components(texts, size, percent)


def test_near_edges(edge, nothing):
    rows = near_groups(edge).collect()
    assert len(rows) == edge.count() and near_groups(nothing).count() == 0
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert got[1] == (0, 1) and got[2] == (0, 2) and got[9] == (0, 9)
    assert got[5] == got[6] == (1, 5) and got[7][1] == got[8][1] == 7 and got[4] == (1, 4)
    assert got[None] == (5, None)


def test_components_of_long_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101), (103, 101), (5, 5)], "u bigint, v bigint")
    got = {r.id: r.component for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 103: 100}


def brute_kept(docs, size):
    first = {}
    words = {i: WORD.findall(t or "") for i, t in docs}
    for i in sorted(words):
        for k in range(len(words[i]) - size + 1):
            first.setdefault(tuple(words[i][k : k + size]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < i:
                gone.update(range(k, k + size))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


@pytest.mark.parametrize("size, depth", [(3, 1), (3, 2), (13, 2)])
def test_kept_words_match_brute_force(spark, size, depth):
    rng = random.Random(size)
    passages = [" ".join(f"p{rng.randrange(40)}" for _ in range(rng.randrange(1, 30))) for _ in range(8)]
    docs = [(i * 7 % 101, "  ".join(rng.choice(passages) for _ in range(rng.randrange(5)))) for i in range(80)]
    df = spark.createDataFrame(docs, "doc_id int, text string").repartition(5)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in without_repeats(df, size=size, depth=depth).collect()}
    assert got == brute_kept(docs, size)


def test_repeat_edges(edge, nothing):
    rows = without_repeats(edge).collect()
    assert len(rows) == edge.count() and without_repeats(nothing).count() == 0
    got = {r.doc_id: r for r in rows}
    assert got[8].n_removed == 30_000 and got[8].kept == "end" and got[7].n_removed == 0
    assert got[1].n_words == got[2].n_words == 0 and got[1].kept_sha256 == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("factor, bounds", [(parity.WIDE, parity.WIDE_BITS), (parity.NARROW, parity.NARROW_BITS)])
def test_sketches_sort_out_pairs_just_beyond_the_threshold(factor, bounds):
    """Sets of 100 that may differ by 16 shingles and do by 20: nearly none are left, so a family of them is not listed pair by pair."""
    rng, left, bits = np.random.default_rng(5), 0, sketch_bits(100, 85, factor, bounds)
    for _ in range(1_000):
        shingles = rng.integers(0, 1 << 63, 110, dtype=np.uint64)
        a, b = (bit_sketch(x, bits) for x in (shingles[:100], shingles[10:]))
        left += int(np.bitwise_count(a ^ b).sum()) * 185 <= 200 * 15
    assert left < 50
