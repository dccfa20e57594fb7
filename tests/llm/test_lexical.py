"""Ranked search against brute force."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from sparkmine.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def by_hand(docs, items, k):
    held = [(i, terms(t)) for i, t in docs if terms(t)]
    n_docs, n_terms = len(held), sum(len(t) for _, t in held)
    df = {}
    for _, t in held:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for i, t in held:
            m = 100 - 25 + 25 * len(t) * n_docs // n_terms
            score = 0
            for x in terms(text):
                if x in df:
                    tf = t.count(x)
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (1_000_000_000 * tf // (1000 * tf + 12 * m))
            if score > 0:
                scored.append((-score, i is not None, i or 0, i))
        scored.sort(key=lambda s: s[:3])
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def frames(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, item_id int, score string").repartition(3)
    q = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, doc_id string")
    return d, q


def sample(seed, n_docs=400, n_items=25):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)] + ["Élan", "élan", "A1"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    docs = [(rnd.randint(0, 10_000), " ".join(rnd.choices(vocabulary, weights, k=rnd.choice([0, 1, 5, 30, 200])))) for _ in range(n_docs)]
    docs += [(d + 1, t) for d, t in docs[:80]]  # ties
    items = [(j, rnd.choice([" ", "-", "\n", "_"]).join(rnd.choices([*vocabulary, "never"], k=rnd.randint(0, 12)))) for j in range(n_items)]
    return docs, items


@pytest.mark.parametrize("leaf", [1, 32])
def test_random(spark, rows, monkeypatch, leaf):
    monkeypatch.setattr(lexical, "LEAF", leaf)
    docs, items = sample(leaf)
    docs += [(7, None), (8, ""), (9, "\x00 !?"), (None, "w0 w1 w59 elan"), (None, "w0 w1 w59 elan"), (11, "w0 " * 50_000), (-4, "W7,w7;w7")]
    items += [(100, None), (101, ""), (102, "w7 W7"), (102, "w59"), (None, "a1 Élan")]
    assert rows(lexical.rank(*frames(spark, docs, items), 20)) == by_hand(docs, items, 20)


def test_trees_of_a_task():
    """Small sets of trees, searched node by node, give what one table gives."""
    docs, items = sample(9, 600, 30)
    number = {}
    vectors = []
    for i, t in docs:
        held = terms(t)
        counts = {}
        for x in held:
            at = number.setdefault(x, len(number))
            counts[at] = counts.get(at, 0) + 1
        if held:
            vectors.append((i, len(held), counts))
    df = np.zeros(len(number), np.int64)
    for _, _, c in vectors:
        df[list(c)] += 1
    asked = [[number[x] for x in terms(t) if x in number] for _, t in items]
    block = lexical.Block(list(range(len(items))), [np.array(sorted(set(a)), np.int64) for a in asked], [np.array([a.count(x) for x in sorted(set(a))], np.int64) for a in asked], number)
    ranking = lexical.Ranking.of(block, len(vectors), sum(n for _, n, _ in vectors), df)
    flat = [(t, c) for _, _, counts in vectors for t, c in counts.items()]
    trees = lexical._trees(ranking, np.array([v[0] for v in vectors]), np.array([v[1] for v in vectors]), np.array([len(v[2]) for v in vectors]), np.array([f[0] for f in flat]), np.array([f[1] for f in flat]))
    assert sum(len(t.term) for t in trees) < len(flat)  # paths are shared
    got = sorted((block.ids[j], s, d) for j, d, s in lexical.ranked_here(ranking, 5, trees))
    assert got == sorted((j, s, d) for j, _, d, s in by_hand(docs, items, 5))


def test_bounds_cut_most_documents():
    """Common words alone reach no rank, so their subtrees are not opened."""
    rnd = random.Random(4)
    ids, n = np.arange(4000), np.full(4000, 40)
    vectors = [sorted(rnd.sample(range(50, 100), 10)) for _ in range(4000)]
    for v in vectors[:30]:
        v[:3] = [0, 1, 2]
    sizes, place = np.full(4000, 10), np.concatenate(vectors)
    tree = lexical.Tree(ids, n, sizes, place, np.ones(len(place), np.int64))
    search = lexical.Search(np.array([0, 1, 2, 60, 70]), np.array([9000, 8500, 8000, 400, 300]), 20, 100)
    search.run(tree, np.ones(5, np.int64))
    assert len(search.best.heap) == 20 and search.scored < 400


def test_several_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 40)
    monkeypatch.setattr(lexical, "ENTRIES", 500)
    docs, items = sample(3, 200)
    assert rows(lexical.rank(*frames(spark, docs, items), 4)) == by_hand(docs, items, 4)


def test_empty_tables(spark):
    docs, items = [(1, "a b")], [(1, "a")]
    assert lexical.rank(*frames(spark, [], items)).collect() == []
    assert lexical.rank(*frames(spark, docs, [])).collect() == []
    assert lexical.rank(*frames(spark, [(1, None)], items)).collect() == []
