"""The pipeline against its stages written out plainly."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_dedup import brute_components
from wardline.llm.quality import fit_quality, quality_score
from wardline.llm.tables import documents, remainder, table


def folded(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain(text):
    return re.sub(r"[\W_]+", " ", text.lower()).strip()


def test_run_matches_the_plain_stages(spark, folder):
    docs = documents(spark, folder)
    model = fit_quality(docs, table(spark, folder, "labels").where(~(remainder(F.col("doc_id"), 4) == 2)))
    rows = docs.where(quality_score(F.col("text"), model) >= 0.7).collect()
    by_text = {}
    for r in rows:
        by_text[folded(r.text)] = max(r.doc_id, by_text.get(folded(r.text), -1))
    rows = sorted((r for r in rows if by_text[folded(r.text)] == r.doc_id), key=lambda r: r.doc_id)
    groups = brute_components([r.text or "" for r in rows], 5, 80)
    rows = [r for i, r in enumerate(rows) if groups[i][1] == i]
    items = [plain(r.text) for r in table(spark, folder, "benchmark").collect()]
    rows = [r for r in rows if not any(f" {t} " in f" {plain(r.text or '')} " for t in items)]
    got = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in got} == {r.doc_id for r in rows}
    used = {}
    for r in got:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in used.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stages_return_the_columns_of_documents(spark, folder, name, stage):
    docs = documents(spark, folder)
    out = stage(spark, docs, folder)
    assert out.schema == docs.schema and 0 < out.count() < docs.count() + 1


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_nulls_and_nothing(spark, folder, edge, nothing, name, stage):
    kept = stage(spark, edge, folder)
    assert name == "packing" or kept.columns == edge.columns
    ids = [r.doc_id for r in kept.collect()]
    if name == "exact_dedup":
        assert sorted(i for i in ids if i) == [2, 4, 6, 7, 8, 9, 10] and None in ids
    if name == "ngram_jaccard":
        assert 7 in ids and 8 not in ids and None in ids
    assert stage(spark, nothing, folder).count() == 0


def test_rows_that_repeat_id_and_text_stay_once(spark, folder):
    rows = [(1, "Same", "a"), (1, "same", "b"), (2, "other", "a"), (3, "other", "b"), (None, "x", "a"), (None, "x", "b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    kept = corpus_pipeline.distinct_texts(spark, docs, folder).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 0, 1, 3]


@pytest.mark.parametrize("rule", ["false", "quality = 1"])
def test_quality_keeps_all_where_nothing_was_learned(spark, folder, monkeypatch, rule):
    docs, read = documents(spark, folder), corpus_pipeline.table
    monkeypatch.setattr(corpus_pipeline, "table", lambda *a: read(*a).where(rule))
    assert corpus_pipeline.good_quality(spark, docs, folder).count() == docs.count()


def test_other_texts_of_an_id_and_rows_without_one(spark, folder):
    item = table(spark, folder, "benchmark").orderBy("item_id").first().text
    copy, clean = " ".join(f"w{i}" for i in range(200)), " ".join(f"v{i}" for i in range(200))

    def kept(stage, rows):
        out = stage(spark, spark.createDataFrame(rows, "doc_id bigint, text string, source string"), folder)
        return sorted((r.doc_id or 0, r.text[:2]) for r in out.collect())

    assert kept(corpus_pipeline.without_benchmark, [(1, item, "a"), (1, clean, "a"), (None, item, "a"), (None, copy, "a"), (2, copy, "b")]) == [
        (0, "w0"), (1, "v0"), (2, "w0")]
    assert kept(corpus_pipeline.distinct_texts, [(1, copy, "a"), (1, clean, "a"), (2, copy, "a"), (None, copy, "a")]) == [
        (0, "w0"), (1, "v0"), (2, "w0")]
    # As stated by the stage: an id's texts go together, rows without an id stay.
    assert kept(corpus_pipeline.one_of_each_group, [(1, copy, "a"), (2, copy + " x", "a"), (2, clean, "a"), (None, copy, "a")]) == [(0, "w0"), (1, "w0")]
