"""Language identification: accuracy on held-out texts and edge cases."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from sparkmine.llm import language

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    known = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = language.predict(docs, language.learn(docs)).collect()
    assert sorted(r.doc_id for r in got) == sorted(known)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    assert sum(r.lang_pred == known[r.doc_id] for r in held) / len(held) >= 0.98


SYLLABLES = {"es": "ca de el la os que", "pt": "ao de em lh os que", "nl": "aa de ij en oe het", "xx": "zu qi ka ro ti mu"}


def text(lang, n, seed):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices(SYLLABLES[lang].split(), k=3)) for _ in range(n))


def made(spark, extra=()):
    rows = [(i, text(lang, 40, i), lang) for i, lang in enumerate(list(SYLLABLES) * 60)]
    return spark.createDataFrame([(i, t, lang, 1, "f") for i, t, lang in rows + list(extra)], "doc_id long, text string, lang string, score int, family string"), rows


def test_families_and_edge_cases(spark):
    edge = [(1000, None, "es"), (1001, "", "es"), (1002, "12 ++ 7", "pt"), (None, text("nl", 30, 5), "nl"), (1003, text("xx", 30, 6), None), (1004, text("es", 60_000, 7), None)]
    docs, rows = made(spark, edge)
    model = language.learn(docs)
    assert model.families.classes == ["germanic", "romance", "xx"] and model.languages["romance"].classes == ["es", "pt"]
    got = {r.doc_id: r for r in language.predict(docs, model).collect()}
    assert sum(got[i].lang_pred == lang for i, _, lang in rows) >= 0.97 * len(rows)
    assert [(got[i].lang_pred, got[i].score) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert (got[None].lang_pred, got[None].held_out) == ("nl", False)
    assert (got[1003].lang_pred, got[1004].lang_pred) == ("xx", "es")
    kept = language.recognised(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {i for i, *_ in rows} | {None, 1003, 1004}
    assert not {r.doc_id for r in kept.collect()} & {1000, 1001, 1002}


def test_held_out_texts_teach_nothing(spark):
    rows = [(i, text("es" if zlib.crc32(str(i).encode()) % 5 else "nl", 30, i), "es" if zlib.crc32(str(i).encode()) % 5 else "nl") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.predict(docs, language.learn(docs)).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("es", 1.0)}


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "words", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in language.predict(docs, language.learn(docs)).collect()] == [("und", 0.0)]
    assert language.predict(docs.limit(0), language.learn(docs.limit(0))).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 3, 50])
def test_slices_of_a_text_add_up(monkeypatch, n):
    whole = language.vector("äbc dE" * n)
    monkeypatch.setattr(language, "SLICE", 5)
    assert np.allclose(language.vector("äbc dE" * n), whole)
    assert n < 2 or np.isclose((whole**2).sum(), 1)


def test_every_labelled_language_teaches(spark):
    docs = spark.createDataFrame([(i, text("xx", 5, i), f"l{i % 70}") for i in range(1400)], "doc_id long, text string, lang string")
    assert language.sample(docs).select("lang").distinct().count() == 70


def test_groups_of_families(spark, monkeypatch):
    """More classes than are held against one another directly."""
    monkeypatch.setattr(language, "WIDEST", 2)
    docs, rows = made(spark)
    model = language.learn(docs)
    assert isinstance(model.families, language.Tree) and model.families.classes == ["germanic", "romance", "xx"]
    got = {r.doc_id: r for r in language.predict(docs, model).collect()}
    assert sum(got[i].lang_pred == lang for i, _, lang in rows) >= 0.97 * len(rows)
    assert language.recognised(docs, model).count() >= 0.97 * len(rows)
