"""Substring removal against brute force."""

from __future__ import annotations

import hashlib
import random
import re

from sparkmine.llm import substrings


def by_hand(docs):
    words = [re.findall("[^\x20\x09-\x0d]+", t or "") for _, t in docs]
    first: dict[tuple, int] = {}
    for (i, _), w in zip(docs, words):
        for k in range(len(w) - 12) if i is not None else ():
            x = tuple(w[k : k + 13])
            first[x] = min(i, first.get(x, i))
    out = []
    for (i, _), w in zip(docs, words):
        gone = set()
        for k in range(len(w) - 12) if i is not None else ():
            if first[tuple(w[k : k + 13])] < i:
                gone |= set(range(k, k + 13))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def cleaned(spark, docs):
    df = spark.createDataFrame([(i, t, 0, "p") for i, t in docs], "doc_id long, text string, doc int, path string").repartition(3)
    return substrings.clean(df)


def test_random_documents(spark, rows):
    """Few words, so that windows repeat, overlap and branch in all ways."""
    random.seed(7)
    pool = [" ".join(random.choices("abcde", k=random.randint(8, 40))) for _ in range(12)]
    docs = []
    for i in range(120):
        parts = [random.choice(pool) if random.random() < 0.7 else " ".join(random.choices("abcdefgh", k=random.randint(0, 20))) for _ in range(random.randint(0, 6))]
        docs.append((i, random.choice([" ", "\n", "  \t"]).join(parts)))
    random.shuffle(docs)
    got = rows(cleaned(spark, docs))
    assert got == by_hand(docs)
    assert sum(r[2] for r in got) > 1000


def test_edge_cases(spark, rows):
    passage = " ".join(f"w{i}" for i in range(60))
    spam = "spam " * 500
    docs = [(4, passage), (2, passage + " tail"), (2, "head " + passage), (9, spam), (1, spam + "x"), (6, None), (7, ""), (8, passage[:50]), (None, passage), (None, passage), (-3, "w0 " + passage)]
    assert rows(cleaned(spark, docs)) == by_hand(docs)


def test_empty_table(spark):
    assert cleaned(spark, []).collect() == []


def test_words_made_to_collide_stay(spark, rows):
    """Windows that differ in one word of 1,024 letters, and a very long text."""
    order = [bin(i).count("1") % 2 for i in range(1024)]
    one, other = ("".join("ab"[b ^ flip] for b in order) for flip in (0, 1))
    rest = " ".join(f"w{i}" for i in range(12))
    docs = [(1, f"{one} {rest}"), (2, f"{other} {rest}"), (3, f"{one} {rest}"), (4, " ".join(f"v{i}" for i in range(200_000))), (5, "v7 " * 100_000)]
    got = rows(cleaned(spark, docs))
    assert got == by_hand(docs) and [r[2] for r in got] == [0, 0, 13, 0, 0]
