"""Token files and packing: exact round trips and brute-force versions."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from wardline.llm import queries
from wardline.llm.coder import BLOCK, Damaged, decode, encode
from wardline.llm import packing
from wardline.llm.packing import _pieces, pack, plan
from wardline.llm.tables import documents
from wardline.llm.token_files import token_table
from wardline.llm import tokens
from wardline.llm.tokens import WordTokens, vocabulary

ODD = ["a<|endoftext|>b  c\n\nd\t e ", "Don't 'tis !'s _x_ x² 3½", "  lead", "", None, "ΑΣ ΟΔΟΣ", "a b", "x \n y", "\nq", "İ İ ß",
       "a\x1cb c", "end ", "two  blanks", "一 二　三", "tail\n"]


def plain(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name, spaces", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
@pytest.mark.parametrize("remembered", [50, 10_000])
def test_ids_are_those_of_the_library(spark, folder, name, spaces, remembered):
    texts = [r.text for r in documents(spark, folder).limit(60).collect()] + ODD
    words = WordTokens(vocabulary(name), spaces, remembered)
    got = [ids[offsets[k] : offsets[k + 1]].tolist() for _, ids, offsets in words.encode(pa.array(texts, pa.string()), 20_000) for k in range(len(offsets) - 1)]
    assert got == [plain(words.tokenizer, t) for t in texts]


@pytest.mark.parametrize("ids", [
    [], [5], [1, 2] * 3000, list(range(5000)), [70_000, 1] * 300, [2**32 - 1] * 9 + [0], [7] * (3 * BLOCK + 1),
    [random.Random(1).choice([3, 9, 40_000]) for _ in range(BLOCK * 2)], [random.Random(2).randrange(65_536) for _ in range(BLOCK + 5)]])
def test_coder_round_trips(ids):
    frame = encode(np.array(ids, np.uint32))
    assert decode(frame).tolist() == ids


def test_blocks_stand_alone_and_damage_is_found():
    ids = np.array([i * i % 97 for i in range(3 * BLOCK)], np.uint32)
    frame = encode(ids, BLOCK)
    assert decode(frame, [1]).tolist() == ids[BLOCK : 2 * BLOCK].tolist() and len(frame) < 2 * len(ids)
    hurt = bytearray(frame)
    hurt[-20] ^= 1
    with pytest.raises(Damaged):
        decode(bytes(hurt))
    assert decode(bytes(hurt), [0]).tolist() == ids[:BLOCK].tolist()
    with pytest.raises(Damaged):
        decode(frame[:-4])


def test_a_damaged_model_is_found():
    frame = bytearray(encode(np.array([3, 1, 4, 1, 5] * 400, np.uint32)))
    frame[25] ^= 4
    with pytest.raises(Damaged):
        decode(bytes(frame))
    with pytest.raises(Damaged):
        decode(bytes(frame[:18]))


@pytest.mark.parametrize("block", [1, 2, 7, 300])
def test_blocks_of_any_size(block):
    rng = random.Random(block)
    ids = np.array([rng.choice([1, 2, 2, 2, 900, 70_000 + rng.randrange(40)]) for _ in range(1500)], np.uint32)
    frame = encode(ids, block)
    assert decode(frame).tolist() == ids.tolist()
    assert decode(frame, [2, 0]).tolist() == ids[2 * block : 3 * block].tolist() + ids[:block].tolist()


def test_many_different_ids():
    """More ids than the table of pairs takes."""
    rng = np.random.default_rng(3)
    ids = np.concatenate([rng.integers(0, 9000, 40_000), np.tile([5, 8999, 17], 3000)]).astype(np.uint32)
    assert decode(encode(ids)).tolist() == ids.tolist()


def test_frames_are_smaller_than_order_0_and_zstd(spark):
    import pyarrow.parquet as pq
    import zstandard

    table = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])
    words = WordTokens(vocabulary("word_bpe_49k.json"), False)
    ids = np.concatenate([np.insert(found, offsets[1:], np.uint32(2)) for _, found, offsets in words.encode(table.column("text").combine_chunks())]).astype(np.uint32)
    share = np.bincount(ids)[np.bincount(ids) > 0] / len(ids)
    frame = encode(ids)
    bits = 8 * len(frame) / len(ids)
    assert bits < -(share * np.log2(share)).sum() - 1 and bits < 7
    assert len(frame) < 0.85 * len(zstandard.compress(ids.astype("<u2").tobytes(), 3))
    assert (decode(frame) == ids).all()


def test_token_files_match_a_plain_count(spark, folder):
    tokenizer = WordTokens(vocabulary("word_bpe_49k.json"), False).tokenizer
    start, want = 0, {}
    for r in sorted(documents(spark, folder).collect(), key=lambda r: r.doc_id):
        ids = plain(tokenizer, r.text) + [2]
        want[r.doc_id] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op5_token_files(spark, folder).collect()}
    assert got == want


def test_token_file_edges(edge, nothing):
    path = vocabulary("word_bpe_49k.json")
    rows = token_table(edge, path, end=2, with_ids=True).collect()
    assert len(rows) == edge.count() and token_table(nothing, path).count() == 0
    rows.sort(key=lambda r: r.start)
    assert rows[0].doc_id is None and [r.doc_id for r in rows[1:]] == sorted(r.doc_id for r in rows[1:])
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))
    assert all(r.ids == [2] for r in rows if r.doc_id in (1, 2, 9))


def check_plan(counts, capacity):
    used, places = {}, plan(counts, capacity)
    for length, rank, n, first, offset in places:
        for k in range(n):
            used.setdefault(first + k, []).append((offset, length))
    assert {s: sum(n for length, _, n, *_ in places if length == s) for s in counts} == counts
    for pieces in used.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity and sum(3 * length > capacity for _, length in pieces) <= 2 + (capacity < 3)
    return len(used)


@pytest.mark.parametrize("seed", range(8))
def test_plans_are_whole_and_close_to_the_bound(seed):
    rng = random.Random(seed)
    counts = {}
    for _ in range(800):
        s = min(100, max(1, int(rng.lognormvariate(3.2, 0.9))))
        counts[s] = counts.get(s, 0) + rng.choice([1, 1, 40])
    sequences = check_plan(counts, 100)
    assert sequences <= 1.06 * sum(s * n for s, n in counts.items()) / 100 + 2 + sum(n for s, n in counts.items() if s > 66) * 0.2


def test_plan_edges():
    assert plan({}, 10) == [] and check_plan({10: 3}, 10) == 3 and check_plan({1: 25}, 10) == 3
    assert check_plan({5: 3, 6: 1, 4: 2}, 10) == 3 and check_plan({7: 2, 3: 2}, 10) == 2


def test_packing_matches_the_texts(spark, folder):
    tokenizer = WordTokens(vocabulary("byte_bpe_50k.json"), True).tokenizer
    want = {}
    for r in documents(spark, folder).collect():
        ids = plain(tokenizer, r.text) + [2]
        head = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(head, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[r.doc_id, k] = (a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
    rows = queries.op7_best_fit_packing(spark, folder).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want
    used = {}
    for r in rows:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in used.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r.length for r in rows)
    assert len(used) <= 1.03 * total / 1024 + 2


def test_packing_edges(edge, nothing):
    path = vocabulary("byte_bpe_50k.json")
    rows = pack(edge, path, 2, 64).collect()
    assert pack(nothing, path, 2).count() == 0
    assert all(r.ids[-1] == 2 for r in rows if r.doc_id in (1, 2)) and sum(r.doc_id == 5 for r in rows) == 2
    assert all(len(r.ids) == r.length <= 64 and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)


def test_packing_can_leave_no_words_in_the_worker():
    """The pipeline's other stages run in the workers that pack."""
    def pieces(keep):
        run = _pieces(vocabulary("byte_bpe_50k.json"), 2, 64, False, keep)
        batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["a few words", None])], ["key", "text"])
        return [b.to_pydict() for b in run(iter([batch]))], len(tokens._LOADED)

    class Context:
        partitionId = staticmethod(lambda: 0)

    plain = packing.TaskContext
    try:
        packing.TaskContext = type("T", (), {"get": staticmethod(lambda: Context)})
        tokens._LOADED.clear()
        (kept, held), (freed, left) = pieces(True), pieces(False)
    finally:
        packing.TaskContext = plain
    assert kept == freed and held == 1 and left == 0
