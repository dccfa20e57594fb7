"""Decontamination against plain alignment of every pair."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from sparkmine.llm import decontaminate


def plain(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall("[^\x20\x09-\x0d]+", re.sub("[!-/:-@\\[-`{-~]", " ", low))


def align_by_hand(item, passage):
    best, above = 0, [0] * (len(passage) + 1)
    for a in item:
        row = [0]
        for j, b in enumerate(passage):
            row.append(max(0, above[j] + (2 if a == b else -1), above[j + 1] - 1, row[j] - 1))
        best, above = max(best, *row), row
    return best


def test_alignment():
    rng = np.random.default_rng(1)
    for _ in range(200):
        item, passage = rng.integers(0, 4, rng.integers(1, 12)), rng.integers(0, 4, rng.integers(1, 30))
        assert decontaminate.align(item, passage)[0] == align_by_hand(item.tolist(), passage.tolist())


def frames(spark, docs, items):
    d = spark.createDataFrame([(i, t, 0, 0.5) for i, t in docs], "doc_id long, text string, item_id int, score double")
    return d, spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")


def corpus():
    random.seed(11)
    words = ["".join(random.choices("abcdefghij", k=random.randint(2, 6))) for _ in range(400)] + ["the", "of"] * 40
    say = lambda n: " ".join(random.choices(words, k=n))
    items = [(i, say(random.randint(12, 40))) for i in range(12)]
    docs, planted = [(i, say(random.randint(0, 200))) for i in range(150)], set()
    for i in range(150, 230):
        item, text = items[i % 12]
        w = text.split()
        for _ in range(len(w) // 8 if i % 2 else 0):  # edits: other word, no word, one more
            k = random.randrange(len(w))
            w[k : k + 1] = random.choice([[random.choice(words)], [], [w[k], random.choice(words)]])
        docs.append((i, f"{say(random.randint(0, 60))} {', '.join(w).upper() if i % 3 else ' '.join(w)} {say(random.randint(0, 60))}"))
        planted.add((i, item))
    return docs, items, planted


def test_planted_and_clean_documents(spark):
    docs, items, planted = corpus()
    d, b = frames(spark, docs, items)
    got = decontaminate.find(d.repartition(3), b).collect()
    assert {(r.doc_id, r.item_id) for r in got} == planted
    text, item = dict(docs), dict(items)
    for r in got:
        passage = plain(text[r.doc_id])
        assert r.score == align_by_hand(plain(item[r.item_id]), passage) / (2 * len(plain(item[r.item_id])))
        assert align_by_hand(plain(item[r.item_id]), passage[r.first_word : r.last_word + 1]) / (2 * len(plain(item[r.item_id]))) == r.score
    kept = decontaminate.without(d, b)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(text) - {i for i, _ in planted})


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs, items, planted = corpus()
    d, b = frames(spark, docs[140:], items)
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 100)
    assert {(r.doc_id, r.item_id) for r in decontaminate.find(d, b).collect()} == planted
    assert decontaminate.without(d, b).count() == 10


def test_item_that_most_documents_hold(spark):
    item = "one very common passage that stands in nearly all the documents of this corpus"
    docs = [(i, f"{i} words before {item} and after {i}") for i in range(60)] + [(99, "clean words only, of this corpus")]
    d, b = frames(spark, docs, [(1, item), (2, "another passage that nobody has copied so far anywhere")])
    assert sorted(r.doc_id for r in decontaminate.find(d, b).collect()) == list(range(60))


def test_edge_cases(spark, rows):
    long = "filler words " * 50_000
    text = "a passage of some length that is asked for here"
    docs = [(1, None), (2, ""), (None, text), (3, long + text), (4, text), (4, text)]
    d, b = frames(spark, docs, [(7, text), (7, text), (8, None), (9, "too short"), (None, text)])
    got = decontaminate.find(d, b)
    assert sorted(((r.doc_id, r.item_id) for r in got.collect()), key=repr) == sorted([(i, j) for i in (None, 3, 4, 4) for j in (7, 7, None)], key=repr)
    assert sorted(r.doc_id for r in decontaminate.without(d, b).collect()) == [1, 2]
    for empty in (frames(spark, [], [(1, text)]), frames(spark, docs, []), frames(spark, [], [])):
        assert decontaminate.find(*empty).collect() == []
        assert decontaminate.without(*empty).count() == empty[0].count()


def edited(words, rng, other):
    """A copy with dense edits, as strong as the score allows or stronger."""
    kind = rng.randrange(4)
    if kind == 0:  # one word more after every one, two or three
        step = rng.randrange(1, 4)
        return [x for i, w in enumerate(words) for x in ([w, other()] if i % step == step - 1 else [w])]
    if kind == 1:  # other words in even distances
        step = rng.randrange(2, 5)
        return [other() if i % step == step - 1 else w for i, w in enumerate(words)]
    if kind == 2:  # every third word is gone
        return [w for i, w in enumerate(words) if i % 3 != 2]
    return [x for w in words for x in rng.choice([[w], [w], [other()], [w, other()], []])]


def test_no_passage_above_the_score_is_missed(spark):
    """Dense insertions, substitutions and deletions, against the alignment of
    every document with every item."""
    rng = random.Random(5)
    other = lambda: rng.choice("stuvwxyz") + str(rng.randrange(60))
    items = [(i, [f"{rng.choice('abcdef')}{rng.randrange(40)}" for _ in range(size)]) for i, size in enumerate([3, 4, 5, 6, 9, 14, 21, 30, 38, 59])]
    docs = []
    for k in range(400):
        middle = edited(items[k % len(items)][1], rng, other)
        docs.append((k, " ".join([other() for _ in range(rng.randrange(8))] + middle + [other() for _ in range(rng.randrange(8))])))
    want = {}
    for k, text in docs:
        for i, words in items:
            score = align_by_hand(words, text.split()) / (2 * len(words))
            if score >= decontaminate.MIN_SCORE:
                want[k, i] = score
    assert len(want) > 150 and min(want.values()) < 0.53
    d, b = frames(spark, docs, [(i, " ".join(w)) for i, w in items])
    assert {(r.doc_id, r.item_id): r.score for r in decontaminate.find(d, b).collect()} == want
    assert decontaminate.without(d, b).count() == len(docs) - len({k for k, _ in want})


def test_equal_paraphrases_do_not_hide_each_other(spark):
    words = [f"w{i}" for i in range(40)]
    copy = [f"x{i}" if i % 4 == 2 and i < 37 else w for i, w in enumerate(words)]
    inserted = [x for i, w in enumerate(words) for x in ([w, f"y{i}"] if i % 2 else [w])]
    for text in (copy, inserted):
        d, b = frames(spark, [(i, " ".join(text)) for i in range(50)] + [(99, " ".join(words[:9]))], [(1, " ".join(words))])
        assert sorted(r.doc_id for r in decontaminate.find(d, b).collect()) == list(range(50))
