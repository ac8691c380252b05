"""SimHash fingerprints and the trie join against plain versions."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wardline.llm import queries, simhash

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_print(text, size=4):
    words = [w.decode() for w in (text or "").translate(FOLD).encode().split()]
    shingles = [" ".join(words[i : i + size]) for i in range(max(len(words) - size + 1, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance):
    """Union of all pairs; ``prints`` maps keys to numbers."""
    keys, root = sorted(prints), {k: k for k in prints}
    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    values = np.array([prints[k] for k in keys], np.uint64)
    for i, k in enumerate(keys):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= distance):
            a, b = sorted((find(k), find(keys[i + 1 + int(j)])))
            root[b] = a
    return {k: find(k) for k in keys}


def test_query_against_plain_version(spark, folder):
    rows = queries.op12_simhash(spark, folder).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    prints = {k: plain_print(t) for k, t in docs.items()}
    assert {r.doc_id: r.fingerprint for r in rows} == {k: f"{p:016x}" for k, p in prints.items()}
    assert {r.doc_id: r.component_id for r in rows} == plain_components(prints, 4)
    assert Counter(r.component_id for r in rows).most_common(1)[0][1] > 1


def test_long_texts_in_blocks(monkeypatch):
    rng = random.Random(4)
    text = " ".join(rng.choice(["Aé", "b", "cc", "東京"]) + "\t" * rng.randrange(3) for _ in range(3000))
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "cut", lambda t, gap: __import__("wardline.llm.words", fromlist=["cut"]).cut(t, gap, 50))
    assert simhash.fingerprint(text.encode()) == whole == np.uint64(plain_print(text)).view(np.int64)
    assert simhash.fingerprint(b"one two") == np.uint64(plain_print("one two")).view(np.int64)


def test_every_close_pair_is_within_budget_in_some_rotation():
    rng = random.Random(5)
    for distance in (1, 2, 4, 7):
        ends = [simhash.block_ends(distance, r) for r in range(distance + 1)]
        starts = simhash.rotation_starts(distance)
        for _ in range(400):
            error = sum(1 << b for b in rng.sample(range(64), distance))
            def within(r):
                turned = (error << starts[r] | error >> (64 - starts[r])) & (2**64 - 1)
                return all((turned >> (64 - e)).bit_count() <= k for k, e in enumerate(ends[r]))
            assert any(within(r) for r in range(distance + 1))


def family(rng, n, spread):
    base = rng.getrandbits(64)
    return [base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(spread + 1))) for _ in range(n)]


@pytest.mark.parametrize("distance,subtree", [(4, 16_384), (4, 8), (4, 40), (2, 10), (1, 10), (7, 30), (0, 5)])
def test_trie_join_against_all_pairs(spark, distance, subtree):
    rng = random.Random(distance * 100 + subtree)
    values = {rng.getrandbits(64) for _ in range(600)} | {v for s in (2, 3, 6, 9) for v in family(rng, 250, s)} | {0, 2**64 - 1, 1}
    values |= {rng.getrandbits(30) << 34 | rng.getrandbits(4) for _ in range(300)}
    signed = [int(np.uint64(v).view(np.int64)) for v in values]
    df = spark.createDataFrame([(v, v) for v in signed], "fingerprint bigint, node bigint")
    links = [(r.u, r.v) for r in simhash.linked_prints(df, distance, subtree).collect()]
    assert all((a ^ b & (2**64 - 1)).bit_count() <= 64 for a, b in links)
    plain = plain_components({v: int(np.int64(v).view(np.uint64)) for v in signed}, distance)
    root = {v: v for v in signed}
    def find(v):
        while root[v] != v:
            v = root[v]
        return v
    for a, b in links:
        assert ((a ^ b) & (2**64 - 1)).bit_count() <= distance
        a, b = sorted((find(a), find(b)))
        root[b] = a
    assert {v: find(v) for v in signed} == plain


def test_a_dense_family_is_not_compared_pair_by_pair(monkeypatch):
    """Some 4,000 fingerprints that all differ in few bits become one class after a part of their pairs."""
    rng = random.Random(8)
    key = np.array(sorted(rng.sample(range(1 << 13), 4000)), np.uint64)
    compared = []
    plain = simhash._compare
    monkeypatch.setattr(simhash, "_compare", lambda pairs, *rest: (compared.append(int(((pairs[1] - pairs[0]) * (pairs[3] - pairs[2])).sum())), plain(pairs, *rest)))
    links = simhash._Links(np.arange(len(key)), len(key))
    n = len(key)
    simhash.walk(key, np.array([[0], [n], [0], [n], [0], [13], [0]]), 4, links)
    assert len(set(links.label.tolist())) == 1 and sum(compared) < n * n / 50
    assert sum(len(u) for u, _ in links.found) < 4 * n


def test_edges(spark, edge, nothing):
    rows = simhash.near_prints(edge).collect()
    assert len(rows) == edge.count() and simhash.near_prints(nothing).count() == 0
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert {k for k, rs in by.items() if rs[0].fingerprint == 0} == {1, 2, 9} and by[9][0].component_id == 1
    assert {r.component_id for k in (5, 6) for r in by[k]} == {5} and by[8][0].component_id == 7
    assert by[None][0].component_id is None and by[4][0].component_id == 4
    with_id = edge.unionByName(edge.where("doc_id is null").withColumn("doc_id", F.lit(99).cast("bigint")))
    assert [r.component_id for r in simhash.near_prints(with_id).where("doc_id is null").collect()] == [99]
    with pytest.raises(ValueError):
        simhash.near_prints(edge, distance=8)
