"""SimHash classes against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from sparkmine.llm import simhash
from sparkmine.llm.components import components


def by_hand(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return bits - (1 << 64) if bits >> 63 else bits


def classes_by_hand(fps):
    u = np.array([f & (1 << 64) - 1 for f in fps], np.uint64)
    root = list(range(len(u)))
    for _ in u:
        new = [min(root[j] for j in np.flatnonzero(np.bitwise_count(u ^ x) <= 2)) for x in u]
        if new == root:
            break
        root = new
    return root


def test_fingerprint(monkeypatch):
    texts = ["The cat sat on THE mat", "two words", "one", "", None, " \n ", "É é É é É", "a b c " * 300]
    assert [simhash.fingerprint(t) for t in texts] == [by_hand(t) for t in texts]
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 7)
    assert simhash.fingerprint(texts[-1]) == by_hand(texts[-1])


def test_golay_code_is_perfect():
    codewords = np.flatnonzero(simhash._remainder(np.arange(1 << 23)) == 0)
    assert len(codewords) == 4096
    assert np.bitwise_count(codewords[1:]).min() == 7


def test_words_one_bit_apart_share_a_key():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 3000)
    other = words ^ (1 << rng.integers(0, 23, 3000))
    for a, b in zip(simhash.golay_keys(words), simhash.golay_keys(other)):
        assert set(a[a >= 0]) & set(b[b >= 0])


def test_linked_fingerprints_share_a_bucket():
    rng = np.random.default_rng(2)
    a = rng.integers(-(1 << 63), 1 << 63, 2000)
    i, j = rng.integers(0, 64, (2, 2000)).astype(np.uint64)
    b = (a.view(np.uint64) ^ (np.uint64(1) << i) ^ (np.uint64(1) << j)).view(np.int64)
    row_a, key_a = simhash.bucket_keys(a)
    row_b, key_b = simhash.bucket_keys(b)
    shared = set(zip(row_a.tolist(), key_a.tolist())) & set(zip(row_b.tolist(), key_b.tolist()))
    assert {r for r, _ in shared} == set(range(2000))


@pytest.mark.parametrize("small", [0, 16])
def test_links_connect_what_two_bits_connect(spark, monkeypatch, small):
    """Also where every bucket counts as large."""
    monkeypatch.setattr(simhash, "SMALL", small)
    random.seed(5)
    fps = {0, -1, 1, 3, 7, 15, 31}
    for _ in range(12):
        x = random.getrandbits(63)
        for _ in range(15):
            fps.add(x)
            x ^= (1 << random.randrange(63)) | (1 << random.randrange(63))
    fps = sorted(fps)
    found = dict(components(simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"))).collect())
    got = [fps.index(found.get(f, f)) for f in fps]
    want = classes_by_hand(fps)
    assert [got.index(g) for g in got] == [want.index(w) for w in want]


def test_classes_and_edge_cases(spark, rows):
    base = "some words that stand in every copy of this rather long line " * 20
    docs = [(5, base), (3, base.upper()), (9, base + "end"), (7, None), (4, ""), (4, ""), (None, base), (None, "alone here"), (8, "quite another text")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, fp string, component_id int")
    fps = [by_hand(t) for _, t in docs]
    roots = classes_by_hand(fps)
    least = {r: min((d[0] for d, s in zip(docs, roots) if s == r and d[0] is not None), default=None) for r in roots}
    assert rows(simhash.classes(df)) == sorted(((d[0], f, least[r]) for d, f, r in zip(docs, fps, roots)), key=repr)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    by_root = {}
    for d, r in zip(docs, roots):
        by_root.setdefault(r, []).append((d[0] is None, d[0] or 0, d[0]))
    assert rows(kept, "doc_id") == sorted([(min(v)[2],) for v in by_root.values()], key=repr)
    assert simhash.classes(df.limit(0)).collect() == [] and simhash.keep_one(df.limit(0)).collect() == []


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(3, 3), (500, 7)]
    found = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in (*range(200, 260), 7, 500)}}
