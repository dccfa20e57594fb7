"""Periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

from sparkmine.llm import runs


def by_hand(ws):
    """Every start and period, one word after another."""
    n, out = len(ws), []
    for p in range(1, n // 2 + 1):
        i = 0
        while i < n - p:
            if ws[i] != ws[i + p]:
                i += 1
                continue
            j = i
            while j < n - p and ws[j] == ws[j + p]:
                j += 1
            length = j - i + p
            if length >= max(12, 2 * p) and not any((i, length) == (s, m) for s, m, _ in out):
                out.append((i, length, p))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(ws, found):
    return " ".join(w for i, w in enumerate(ws) if not any(s + p <= i < s + n for s, n, p in found))


def judged(texts):
    return [([tuple(r) for r in found], text.decode()) for found, text in runs._judge([t.encode().split() for t in texts])]


def test_cover_has_every_difference():
    assert {(a - b) % runs.V for a in runs.COVER for b in runs.COVER} == set(range(runs.V))
    assert runs.SYNC.max() < runs.V


def sample(rnd):
    ws = []
    while len(ws) < rnd.randint(0, 150):
        part = rnd.choices("abcd"[: rnd.randint(1, 4)], k=rnd.randint(1, 12))
        ws += part * rnd.randint(1, 6)
        if rnd.random() < 0.3:
            ws += [f"w{rnd.randint(0, 9)}" for _ in range(rnd.randint(1, 20))]
    return " ".join(ws)


def test_random_texts():
    rnd = random.Random(11)
    texts = [sample(rnd) for _ in range(400)] + ["", "a", "a " * 11, "a " * 12, "a b " * 6, "a b " * 5 + "a"]
    want = [by_hand(t.split()) for t in texts]
    assert judged(texts) == [(w, collapsed(t.split(), w)) for t, w in zip(texts, want)]
    assert sum(map(len, want)) > 400


def test_slices(monkeypatch):
    """The same with questions asked in small slices, one text at a time."""
    monkeypatch.setattr(runs, "PAIRS", 50)
    rnd = random.Random(5)
    texts = [sample(rnd) for _ in range(60)]
    assert [found for found, _ in judged(texts)] == [by_hand(t.split()) for t in texts]


def test_extensions():
    rnd = np.random.default_rng(3)
    ids = np.append(np.tile(rnd.integers(0, 3, 40), 6), 7)
    found = runs.Extensions(ids)
    i, j = np.triu_indices(len(ids), 1)
    want = [next(t for t in range(len(ids)) if ids[a + t] != ids[b + t]) for a, b in zip(i, j)]
    assert found.length(i, j).tolist() == want


@pytest.mark.parametrize("unit, times", [("a", 200_000), ("a b c d e f g", 40_000), (" ".join(f"w{i}" for i in range(50_000)), 3)])
def test_long_texts(unit, times):
    start = time.time()
    n, q = len(unit.split()) * times, len(unit.split())
    assert judged([f"{unit} " * times]) == [([(0, n, q)], unit)]
    assert time.time() - start < 60


def test_nested_periods():
    """Runs of runs: every level is found."""
    ws = "a"
    for k in range(9):
        ws = f"{ws} {ws} {'bcdefghij'[k]}"
    assert judged([f"{ws} {ws}"])[0][0] == by_hand(f"{ws} {ws}".split())


def planted(doc_id, text):
    ws = re.findall("[^\x20\x09-\x0d]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(ws)
    if doc_id is None or h % 10 or not n:
        return ws
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)]


def test_query(spark, rows):
    rnd = random.Random(2)
    docs = [(i, sample(rnd) if i % 3 else " ".join(f"x{rnd.randint(0, 99)}" for _ in range(rnd.randint(0, 200)))) for i in range(300)]
    docs += [(5, None), (5, ""), (-10, " \x0b\t"), (None, "a b " * 40), (7, docs[7][1]), (12, "é" * 70_000), (2**62, "a\nb\r\x0c" * 50)]
    df = spark.createDataFrame([(i, t, "x", [1]) for i, t in docs], "doc_id long, text string, runs string, best array<int>")
    text = runs.plant(df["doc_id"], df["text"]).alias("text")
    want = []
    for i, t in docs:
        ws = planted(i, t)
        found = by_hand(ws)
        best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        digest = hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in found).encode()).hexdigest()
        head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        want.append((i, len(found), *head, digest, hashlib.sha256(collapsed(ws, found).encode()).hexdigest()))
    got = rows(runs.digests(runs.find(df.select("doc_id", text, "runs", "best").repartition(3))))
    assert got == sorted(want, key=repr)
    assert sum(w[1] for w in want) > 100


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert runs.digests(runs.find(df)).collect() == []
