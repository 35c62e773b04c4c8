"""Nulls, empty and very long texts, repeated rows, empty tables and clashing extra columns, for every operator."""

import pytest

from brinework.llm import bpe, embedding_dedup, html_extraction, language_id, license_scan, packing, quality_rules, sharding, simhash, url_filters
from brinework.llm.queries import tokenizer_path

CLASH = "text string, fingerprint string, component_id int, kept string, slot int, size int, id int, ids int, n_tokens int, lang string, source string, n_chars bigint, piece int, sequence_id int, fp int, label string, `a b` int"
LONG = "long word " * 20_000 + "x" * 50_000
ROWS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "plain words here and there"), (4, "plain words here and there"),
    (None, "plain words here and there"), (None, None), (5, LONG), (6, "|||| #### 123 <|endoftext|>"), (7, "\u00e9\u00e9 \U0001f642"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "f", 7, "k", 1, 2, 3, 4, 5, "en", "s", 3, 1, 2, 3, "l", 9) for i, t in ROWS]
    return spark.createDataFrame(rows, "doc_id bigint, " + CLASH)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def run_all(docs, labels):
    yield quality_rules.judge(docs, quality_rules.train(docs, labels))
    yield sharding.assign(docs)
    yield simhash.near_duplicates(docs)
    yield bpe.round_trip(docs, tokenizer_path())
    yield license_scan.scan(docs)
    yield language_id.identify(docs, language_id.train(docs))


def test_one_row_per_document(spark, docs, none):
    labels = spark.createDataFrame([(1, 0), (4, 1), (None, 1), (5, None)], "doc_id bigint, quality int")
    for out in run_all(docs, labels):
        assert sorted(map(str, (r.doc_id for r in out.collect()))) == sorted(str(i) for i, _ in ROWS)
    for out in run_all(none, labels.limit(0)):
        assert out.collect() == []


def test_filters_keep_columns(spark, docs, none):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    for d in (docs, none):
        model = language_id.train(d)
        for out in (quality_rules.keep_good(d, None), language_id.keep_known(d, model, 0.0), simhash.keep_one(d)):
            assert out.schema == d.schema
            out.collect()
    assert quality_rules.train(docs, labels) is None
    # null, empty and blank texts share fingerprint zero; equal texts are one group
    kept = sorted(str(r.doc_id) for r in simhash.keep_one(docs).collect())
    assert kept == ["1", "4", "5", "6", "7"]


def test_packing_edges(docs, none):
    rows = packing.pack_documents(docs, tokenizer_path()).collect()
    assert sorted(str(r.doc_id) for r in rows if r.piece == 0) == sorted(str(i) for i, _ in ROWS)
    assert [r.length for r in rows if r.doc_id == 1] == [1]
    assert packing.pack_documents(none, tokenizer_path()).collect() == []


def test_pages(spark):
    schema = "page_id bigint, url string, html string, host string, path string, rule string, domain string, suffix string, id int, good int, text int"
    rows = [(1, None, None), (2, "", ""), (2, "", ""), (None, "http://a.org/x", "<p>hi"), (4, "no scheme", "<"), (5, "x://HOST?q", "a" * 100)]
    pages = spark.createDataFrame([(*r, "h", "p", "r", "d", "s", 1, 1, 1) for r in rows], schema)
    good = spark.createDataFrame([(2, 1), (None, 0), (9, None)], "page_id bigint, good int")
    for table, n in ((pages, 6), (pages.limit(0), 0)):
        assert html_extraction.extract(table).count() == n
        assert url_filters.judge(table, good).count() == n
    got = {r.page_id: r for r in url_filters.judge(pages, good.limit(0)).collect()}
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("", "", None, "allow")
    assert (got[5].host, got[5].path) == ("host", "")


def test_embeddings(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, None, 1), (4, [0.0, 0.0], 1), (5, [nan, 1.0], 1),
        (6, [inf, 1.0], 1), (7, [None, 1.0], 1), (8, [1.0, 0.0], None), (9, [1.0, 0.0], 2), (10, [], 1), (11, [1.0, 0.0, 0.0], 1), (None, [0.0, 1.0], 1),
    ]
    t = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "vec_id bigint, embedding array<float>, label int, node int, weight int, vector int")
    got = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(t).collect()}
    assert {(1, 2, 1, True), (2, 2, 1, False), (8, 0, 8, True), (9, 0, 9, True), (11, 0, 11, True), (None, 0, None, True)} < got
    assert all((i, 0, i, True) in got for i in (3, 4, 5, 6, 7, 10))
    assert embedding_dedup.near_duplicates(t.limit(0)).collect() == []
