from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from sparkmine.functions.text import hashtags, strip_commas, tokens, tracked
from sparkmine.operators import text

TEXTS = {1: "the cat  sat ", 2: "the the dog", 3: "   ", 4: "", 5: "cat"}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(TEXTS.items()), "doc_id BIGINT, text STRING")


def words(line: str) -> list[str]:
    """Split on blanks, without trailing empty words."""
    if line == "":
        return [""]
    out = line.split(" ")
    while out and out[-1] == "":
        out.pop()
    return out


@pytest.mark.parametrize("line", ["a  b ", "", " ", "    ", " a", "a b", "a\t b ", "x \n", "a"])
def test_tokens(spark, line):
    df = spark.createDataFrame([(line,)], "t STRING")
    assert df.select(tokens("t")).first()[0] == words(line)


def test_small_expressions(spark):
    df = spark.createDataFrame([("Big #Data, #data #x_1 1,000,", None)], "t STRING, n STRING")
    got = df.select(
        strip_commas("t"), hashtags("t"), tracked("t", "DATA"), tracked("t", "other"), strip_commas("n")
    ).first()
    assert tuple(got) == ("Big #Data #data #x_1 1000", ["Data", "data", "x_1"], True, False, None)


def test_tf_and_idf(docs):
    tf = text.document_tf(docs)
    want = {(d, w): float(n) for d, t in TEXTS.items() for w, n in Counter(words(t)).items()}
    assert {(r.doc_id, r.term): r.weight for r in tf.collect()} == want
    df = Counter(w for _, w in want)
    weights = {w: math.log(6 / (n + 1)) for w, n in df.items()}
    for r in text.idf(tf, len(TEXTS)).collect():
        assert r.idf == pytest.approx(weights[r.term])
    got = {(r.doc_id, r.term): r.weight for r in text.tfidf(tf, len(TEXTS)).collect()}
    assert got == pytest.approx({(d, w): n * weights[w] for (d, w), n in want.items()})


@pytest.mark.parametrize("features", ["tf", "TFIDF"])
def test_vectors_keep_every_document(docs, features):
    got = {r.id: r for r in text.vectorize(docs, features).collect()}
    assert got.keys() == TEXTS.keys()
    assert got[3].idx == [] and got[3].val == []
    assert got[1].idx == sorted(got[1].idx) and len(got[1].val) == 4 - 0
    if features == "tf":
        assert sorted(got[2].val) == [1.0, 2.0]
    else:
        assert sorted(got[2].val) == pytest.approx(sorted([2 * math.log(6 / 3), math.log(6 / 2)]))


def test_unknown_features(docs):
    with pytest.raises(ValueError):
        text.vectorize(docs, "bm25")


def test_documents_are_not_moved(docs):
    for df in (text.vectorize(docs), text.document_tf(docs)):
        assert "Exchange" not in plan_of(df)


def test_words_in_place_after_dealing_by_document(docs):
    plan = plan_of(text.term_frequency(text.tokenize(text.by_document(docs))))
    assert plan.count("Exchange") == 1


def test_parts_grow_in_number_with_the_text(spark):
    docs = spark.createDataFrame([(i, "a b c d e " * 10) for i in range(40)] + [(40, None)], "doc_id BIGINT, text STRING")
    dealt = text.by_document(docs, chars=100)
    assert dealt.rdd.getNumPartitions() == 40 and dealt.count() == 41
    assert text.by_document(docs).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_wide_vectors_are_weighted_by_join(docs, monkeypatch):
    narrow = {r.id: r for r in text.vectorize(docs, "tfidf").collect()}
    monkeypatch.setattr(text, "BROADCAST_SLOTS", 0)
    wide = {r.id: r for r in text.vectorize(docs, "tfidf").collect()}
    assert wide.keys() == narrow.keys()
    for i, r in wide.items():
        assert r.idx == narrow[i].idx and r.val == pytest.approx(narrow[i].val)


@pytest.mark.parametrize("line", ["b a b  c a b", "", "  ", "x"])
def test_counted_inside_the_row(spark, line):
    df = spark.createDataFrame([(1, line)], "doc_id BIGINT, text STRING")
    got = {r.term: r.weight for r in text.document_tf(df).collect()}
    again = {r.term: r.weight for r in text.term_frequency(text.tokenize(df)).collect()}
    assert got == again == Counter(words(line))


def test_ml_vectors_keep_distances(docs):
    got = text.ml_tfidf(docs).select("id", F.unwrap_udt("features").alias("v")).collect()
    sizes = {r.v["size"] for r in got}
    assert len(sizes) == 1 and sizes.pop() < 10
    assert len(got) == len(TEXTS)
