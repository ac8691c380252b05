"""Secrets, URL rules and decontamination against plain versions of the same rules."""

import hashlib
import random
import re
import string

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.compare import compare, duck
from wardline.llm import queries
from wardline.llm.oracle import SQL
from wardline.llm.secrets import Scanner, scan_secrets
from wardline.llm.tables import documents, table
from wardline.llm.templates import leaks
from wardline.llm.url_rules import Rule, as_regex, judge_urls, tokens_of


def base_spans(text):
    found = [("assign", *m.span()) for m in re.finditer(
        r'''(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)''', text) if len(m[2]) >= 8]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    order = ("assign", "access", "hex")
    return sorted(found, key=lambda s: (s[1], order.index(s[0])))


def test_base_spans_match_a_plain_scan(spark, folder):
    got = {r.doc_id: r for r in queries.op1_secret_scan(spark, folder).collect()}
    rows = documents(spark, folder).collect()
    assert len(got) == len(rows)
    for r in rows:
        want = base_spans(r.text or "")
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert got[r.doc_id].base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert got[r.doc_id].n_hex == sum(k == "hex" for k, *_ in want)
        assert set(line.split(",")) <= set(got[r.doc_id].spans.split(","))


def test_base_edges():
    scan = Scanner()
    assert scan.spans("tokKen=abcdefgh") == []
    assert [s[0] for s in scan.spans("API_KEY: 'abcdefgh' passwd=short")] == ["assign"]
    assert scan.spans("AKIA" + "B" * 11) == [] and scan.spans("a" * 31) == []
    assert scan.spans("é" + "f" * 32)[0][1:3] == (1, 33)


def test_a_key_in_a_sensitive_place_is_novel_and_prose_is_not():
    scan = Scanner()
    key = "q9Zt7Lx2Vb8Rm4Kp1Ws6"
    found = scan.spans(f"Authorization Bearer {key} was sent")
    assert [(s[0], s[1], s[2]) for s in found] == [("novel", 21, 21 + len(key))] and found[0][3] >= scan.novelty
    assert scan.spans(f"the word {key} stands in no such place") == []
    assert scan.spans("the bearer example.com/version1/configuration1/production1 of it") == []
    assert scan.spans(f"bearer {key} and bearer {key}")[0][0] == "novel"


def _keys(alphabet, size, n=300):
    rng = random.Random(size)
    return ["".join(rng.choice(alphabet) for _ in range(size)) for _ in range(n)]


@pytest.mark.parametrize("alphabet, size", [
    (string.ascii_letters, 16), (string.ascii_letters, 20), (string.ascii_letters + string.digits, 12),
    (string.ascii_letters + string.digits, 16), (string.ascii_letters + string.digits, 32), (string.digits + "abcdef", 24)])
def test_keys_in_sensitive_places_are_found(alphabet, size):
    """Whatever letters and digits a key has; the texts are those of the corpus."""
    rng, scan = random.Random(size), Scanner()
    texts = [t for t in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column("text").to_pylist() if t and len(t) > 600]
    found = 0
    keys = _keys(alphabet, size)
    for key in keys:
        text = rng.choice(texts)
        at = text.index(" ", rng.randrange(len(text) // 2))
        start = at + len(" Authorization: Bearer ")
        found += ("novel", start, start + size) in [s[:3] for s in scan.spans(f"{text[:at]} Authorization: Bearer {key}{text[at:]}")]
    assert found >= 0.95 * len(keys)


def test_few_words_of_the_corpus_are_taken_for_keys():
    """Long words behind a sensitive one, in 10,000 documents."""
    scan, seen, reports = Scanner(), 0, 0
    open_ = Scanner(novelty=-9.0)
    for text in pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text"]).column("text").to_pylist():
        seen += sum(s[0] == "novel" for s in open_.spans(text))
        reports += sum(s[0] == "novel" and s[3] >= scan.novelty for s in open_.spans(text))
    assert seen >= 10 and reports <= 2


def test_words_in_a_sensitive_place_are_no_keys():
    """Every long word of the corpus, put behind a sensitive word."""
    scan, n, wrong = Scanner(), 0, 0
    for text in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column("text").to_pylist():
        for m in list(re.finditer(r"(?<= )[A-Za-z]{12,}(?= )", text or ""))[:2]:
            if len(text) > 600:
                n += 1
                wrong += any(s[0] == "novel" for s in scan.spans(f"{text[: m.start()]}token {text[m.start() :]}"[max(0, m.start() - 2000) : m.end() + 2000]))
    assert n > 300 and wrong <= 0.03 * n


def test_secret_edges(edge, nothing):
    rows = scan_secrets(edge).collect()
    assert len(rows) == edge.count() and all(r.secrets == [] for r in rows if not r.text)
    assert scan_secrets(nothing).count() == 0
    many = "password=abcdefgh1 " * 5_000
    assert len(Scanner().spans(many)) == 5_000


def test_url_rules_match_the_sql(spark, folder):
    assert compare(queries.op2_url_filter(spark, folder), duck(folder), SQL["op2_url_filter"]) == []


def test_url_edges(spark):
    urls = [None, "", "no scheme", "http://", "http://COM/", "http://a.com", "http://a.com/x", "http://example.com/en/",
            "http://www.EXAMPLE.com/en/q?x", "http://bad.net/es/", "http://netx/es/", "http:///net/es/", "http://x.org/CASINO/", "http://x.org/casinos"]
    df = spark.createDataFrame([(i, u, "t") for i, u in enumerate(urls)] * 2, "page_id int, url string, token string")
    got = {r.url: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(df).collect()}
    assert judge_urls(df).count() == 2 * len(urls)
    assert got[None] == got["no scheme"] == ("", "", None, "allow")
    assert got["http://COM/"] == ("com", "/", "com/", "allow") and got["http://a.com"][2] is None
    assert got["http://example.com/en/"][2:] == ("example.com/en/", "block")
    assert got["http://www.EXAMPLE.com/en/q?x"] == ("www.example.com", "/en/q", "www.example.com/en/", "allow")
    assert got["http://bad.net/es/"][2] == "net/es/" and got["http://netx/es/"][2] is None and got["http:///net/es/"][2] is None
    assert got["http://x.org/CASINO/"][2:] == (None, "block") and got["http://x.org/casinos"][3] == "allow"
    assert judge_urls(df.limit(0)).count() == 0


def test_only_a_rule_s_own_tokens_fetch_it(spark):
    rules = (Rule("r", "^deals^*^today^", "block"), Rule("s", "plain", "block"), Rule("t", "||shop.example^", "allow"))
    assert [tokens_of(r) for r in rules] == [["deals", "today"], [], ["example", "shop"]]
    urls = ["http://x/deals/for/today", "http://x/today/deals", "http://explained.com/", "http://shop.example/plain"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = {r.url: r.verdict for r in judge_urls(df, rules=rules).collect()}
    want = {}
    for u in urls:
        fits = {r.verdict for r in rules if re.search(as_regex(r), u.split("://")[1])}
        want[u] = "block" if fits == {"block"} else "allow"
    assert got == want


ITEM = "Mary buys 12 apples for 3 dollars at the corner shop and then sells 12 of them to her friend Tom for 5 dollars each"


@pytest.mark.parametrize("text, changed", [
    (ITEM, 0), ("so it said: " + ITEM.lower().replace("mary", "Mary").replace("tom", "Tom") + " and more", 0),
    (ITEM.replace("12", "40").replace("Tom", "Paul"), 2), (ITEM.replace("Mary", "Ann"), 0)])
def test_reparameterised_items_are_leaks(spark, text, changed):
    docs = spark.createDataFrame([(1, text), (2, "nothing of the kind is found in this text at all")], "doc_id int, text string")
    items = spark.createDataFrame([(7, ITEM)], "item_id int, text string")
    assert [(r.doc_id, r.item_id, r.n_changed) for r in leaks(docs, items).collect()] == [(1, 7, changed)]


def test_inconsistent_slots_are_no_leak(spark):
    # 12 stands for 40 at one place and for 41 at the other.
    text = ITEM.replace("12", "40", 1).replace("12", "41", 1)
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    items = spark.createDataFrame([(7, ITEM)], "item_id int, text string")
    assert leaks(docs, items).count() == 0


def test_leaks_match_a_plain_search(spark, folder):
    norm = lambda t: re.sub(r"[\W_]+", " ", t.lower()).strip()
    items = {r.item_id: norm(r.text) for r in table(spark, folder, "benchmark").collect()}
    want = {(d.doc_id, i) for d in documents(spark, folder).collect() for i, t in items.items() if f" {t} " in f" {norm(d.text or '')} "}
    got = {(r.doc_id, r.item_id) for r in queries.op10_benchmark_decontamination(spark, folder).collect()}
    assert want <= got and len(got - want) <= 1 + len(want) // 10


def test_leak_edges(spark, edge, nothing):
    items = spark.createDataFrame([(1, ""), (2, None), (3, "one two three"), (4, "one two three"), (None, "a")], "item_id int, text string")
    got = {(r.doc_id, r.item_id) for r in leaks(edge, items).collect()}
    assert {(5, 3), (5, 4), (6, 3), (6, 4)} <= got and all(d not in (1, 2, 9) for d, _ in got)
    assert leaks(nothing, items).count() == leaks(edge, items.limit(0)).count() == 0
    rng = random.Random(3)
    words = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{i}x" for i in range(20)]
    assert leaks(edge.select("doc_id", F.lit(" ".join(words)).alias("text")).limit(2), spark.createDataFrame([(9, " ".join(words))], "item_id int, text string")).count() >= 1


@pytest.mark.parametrize("item", ["What is the capital of France", "one two three", "photosynthesis"])
def test_a_short_item_is_found_inside_a_long_text(spark, item):
    rows = [(1, f"Some words come first and then it asks: {item}? More words come after it, to the end."), (2, item),
            (3, "Some words come first and none of the items does, one two and capital of are no item")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    items = spark.createDataFrame([(7, item), (8, ITEM)], "item_id int, text string")
    assert sorted((r.doc_id, r.item_id) for r in leaks(docs, items).collect()) == [(1, 7), (2, 7)]


@pytest.mark.parametrize("item, others", [
    ("Tom ran 5 km in 20 minutes and 8 km in 35 minutes", {"Tom ran 6 km in 21 minutes and 9 km in 36 minutes": 4, "Tom ran 6 km in 21 minutes and he was tired of it": None}),
    ("What is 345 times 27", {"What is 12 times 9": 2, "What is 345 and 27": None}),
    ("345 + 27", {"345 + 28": None}), ("Sum 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15", {"Sum 1 2 3 4 5 6 7 and 9 10 11 12 13 14 15": None})])
def test_items_of_few_literal_words_are_leaks(spark, item, others):
    frame = "some words come first, then: {}. and then come more words"
    rows = [(item, 0), *others.items()]
    docs = spark.createDataFrame([(i, frame.format(t)) for i, (t, _) in enumerate(rows)], "doc_id int, text string")
    items = spark.createDataFrame([(7, item)], "item_id int, text string")
    got = {r.doc_id: r.n_changed for r in leaks(docs, items).collect()}
    assert got == {i: n for i, (_, n) in enumerate(rows) if n is not None}


def test_a_key_that_begins_at_the_end_of_the_reach_is_weighed():
    scan, key = Scanner(), "q9Zt7Lx2Vb8Rm4Kp1Ws6"
    for gap in (60, 70, 79, 80):
        text = "bearer" + " " * gap + key
        assert [x[1:3] for x in scan.spans(text)] == ([(6 + gap, 6 + gap + len(key))] if gap < 80 else [])
