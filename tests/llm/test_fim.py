"""Fill-in-the-middle against SQL, a plain version, and exact round trips."""

import hashlib
import random
import re

import pytest

from tests.compare import compare, duck
from wardline.llm import fim, queries
from wardline.llm.oracle import SQL


def plain_output(key, text, plan):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    x = hashlib.sha256(f"{plan.seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(x[8 * i : 8 * i + 8], 16) for i in range(4)]
    i, j = sorted(v % (len(units) + 1) for v in h[:2])
    if not text or any(m in text for m in (plan.prefix, plan.suffix, plan.middle)) or h[2] % 100 >= plan.rate:
        return len(units), "plain", None, None, text
    p, m, s = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
    spm = h[3] % 100 < plan.suffix_first
    a, b = plan.prefix + p, plan.suffix + s
    return len(units), "spm" if spm else "psm", len(p), len(m), (b + a if spm else a + b) + plan.middle + m


def test_query_matches_the_sql(spark, folder):
    name = "op13_fill_in_middle"
    assert compare(queries.QUERIES[name](spark, folder), duck(folder), SQL[name]) == []


@pytest.fixture
def texts(spark):
    rng = random.Random(9)
    rows = [(k, "".join(rng.choice("ab \n\n\réé東\x00") for _ in range(rng.randrange(200)))) for k in range(150)]
    rows += [(200, "\n"), (201, "no line feed"), (202, "a\n<P>\nb"), (203, "<S"), (204, "<M>"), (205, "< P>\n<P\n>"), (206, ""), (207, None),
             (208, "é" * 5000 + "\n" + "x\n" * 3000), (209, "\n" * 500), (None, "a\nb\nc\n"), (150, "same\nkey"), (150, "same\nkey"), (150, "other\ntext\n")]
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)


@pytest.mark.parametrize("plan", [fim.Plan(), fim.Plan(seed=3, rate=60, suffix_first=0, prefix="[pre]", suffix="[suf]", middle="[mid]")])
@pytest.mark.parametrize("piece", [7, 1000, fim.PIECE])
def test_pieces_make_the_output_and_give_the_text_back(spark, texts, plan, piece):
    from unittest import mock

    rows, df = texts
    want = sorted((k is None, k or 0, *map(str, plain_output(k, t, plan)), t or "") for k, t in rows)
    with mock.patch.object(fim, "PIECE", piece):  # chunks of one text, here; the query below in the workers
        for key, text in rows:
            raw = (text or "").encode()
            head, pieces = fim.arranged(key, raw, plan)
            out = plain_output(key, text, plan)
            assert head == out[:4] and b"".join(pieces).decode() == out[4]
            marked = max(map(len, plan.marks))
            assert all(len(p) <= max(piece, 1) + marked for p in pieces) and (raw == b"" or all(pieces))
    got = fim.fim_texts(df, plan=plan).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, str(r.n), r.form, str(r.prefix_chars), str(r.middle_chars), r.output) for r in got) == [w[:-1] for w in want]
    sums = fim.fim_digests(df, plan=plan).collect()
    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.output_sha256, r.restored_sha256) for r in sums) == sorted((w[0], w[1], sha(w[6]), sha(w[7])) for w in want)


def test_restoration_reads_output_and_form_only():
    """A changed output gives another text back."""
    plan = fim.Plan()
    text = b"".join(b"line %d\n" % i for i in range(50))
    key = next(k for k in range(100) if fim.arranged(k, text, plan)[0][1] == "spm" and min(fim.arranged(k, text, plan)[0][2:]) > 0)
    import pyarrow as pa

    batches = list(fim._emit(plan)([pa.record_batch([pa.array([0]), pa.array([key]), pa.array([text.decode()])], ["row", "doc_id", "text"])]))
    def restored(batch):
        split = pa.Table.from_batches(list(fim._split_output(plan)([batch]))).sort_by([("row", "ascending"), ("place", "ascending")])
        return pa.Table.from_batches(list(fim._restored(split.to_batches()))).to_pylist()[0]
    whole = pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
    assert restored(whole)["restored_sha256"] == hashlib.sha256(text).hexdigest()
    data = whole.column(2).to_pylist()
    data[0] = data[0].replace(b"line", b"lime", 1)
    other = whole.set_column(2, "data", pa.array(data, pa.binary()))
    assert restored(other)["restored_sha256"] != hashlib.sha256(text).hexdigest()


def test_pieces_of_a_row_are_together_and_in_order(spark, texts):
    _, df = texts
    seen = []
    for part in fim.fim_pieces(df).select("row", "place").rdd.glom().collect():
        names = [(r.row, r.place) for r in part]
        assert names == sorted(names)
        seen += {r for r, _ in names}
    assert len(seen) == len(set(seen)) == len(texts[0])


def test_edges(edge, nothing):
    rows = fim.fim_digests(edge).collect()
    assert len(rows) == edge.count() and fim.fim_digests(nothing).count() == fim.fim_texts(nothing).count() == 0
    by = {r.doc_id: r for r in rows}
    empty = hashlib.sha256(b"").hexdigest()
    assert (by[2].n, by[2].form, by[2].prefix_chars, by[2].output_sha256, by[2].restored_sha256) == (0, "plain", None, empty, empty)
    assert by[9].n == 2 and by[None].n == 1 and fim.fim_digests(edge).columns[0] == "doc_id"
