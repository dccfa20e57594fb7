"""Mixing: targets by hand, sums near them, expectations kept."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from sparkmine.llm import mixing


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, text string, size string, row int, n string, x int")


def targets_by_hand(sizes):
    """Fill level by rounds of resharing, source by source."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    if not total:
        return dict.fromkeys(sizes, 0.0)
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        share = sum(weight[s] for s in sizes if s not in full)
        want = {s: 3 * sizes[s] if s in full else left * weight[s] / share for s in sizes}
        over = {s for s in sizes if s not in full and want[s] > 3 * sizes[s]}
        if not over:
            return want
        full |= over


def test_mix(spark):
    random.seed(2)
    rows = []
    for source, n in (("b", 400), ("a", 30), (None, 150), ("ü", 9), ("z", 0), ("c", 90)):
        rows += [(len(rows) + i, source, "w " * random.choice([1, 5, 20, 200]), "", 1, "", 2) for i in range(n)]
    rows += [(9000, "tiny", "one", "", 1, "", 2), (9001, "void", None, "", 1, "", 2), (9002, "void", " \n", "", 1, "", 2)]
    got = mixing.mix(docs_of(spark, rows)).collect()
    of = {r[0]: r for r in rows}
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        source = of[r.doc_id][1]
        assert r.size == len((of[r.doc_id][2] or "").split())
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        sizes[source] += r.size
        taken[source] += r.taken
    want = targets_by_hand(sizes)
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == sizes[of[r.doc_id][1]]
        assert r.target == pytest.approx(want[of[r.doc_id][1]])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 101, s  # half of the longest text
    assert abs(taken["b"] - want["b"]) < 0.01 * want["b"]
    again = mixing.mix(docs_of(spark, rows).repartition(5)).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)


def test_expectations_are_kept(spark):
    """Over 60 draws documents of every size are taken as often as their
    fraction says (0.3; five standard deviations of a share are 0.3)."""
    size = [1 + i % 7 * 10 for i in range(40)]
    rows = [(f"s{d}", 40, i * 1000 + d, 0, 100 * d + i, size[i], 0.3) for d in range(60) for i in range(40)]
    df = spark.createDataFrame(rows, "source string, n long, who long, salt long, row long, size long, x double")
    up = {b.row: b.up for b in mixing.rounded(df).collect()}
    assert sorted(up) == sorted(r[4] for r in rows)
    for k in range(7):
        shares = [up[100 * d + i] for d in range(60) for i in range(k, 40, 7)]
        assert 0.05 < sum(shares) / len(shares) < 0.6
    for d in range(60):
        assert abs(sum(size[i] * up[100 * d + i] for i in range(40)) - 0.3 * sum(size)) <= 31


def test_repeated_rows_and_hot_source(spark):
    """Equal rows beyond the size of a block are spread and rounded apart."""
    rows = [(1, "a", "w w w", "", 1, "", 2)] * 300 + [(i, "b", "w", "", 1, "", 2) for i in range(2, 200)]
    got = mixing.mix(docs_of(spark, rows)).collect()
    for r in got[:1] + got[-1:]:
        assert abs(sum(x.taken for x in got if x.source_size == r.source_size) - r.target) <= 3


def test_mixed_rows_keep_their_columns(spark):
    rows = [(i, "ab"[i % 2], "w " * (i % 5), f"s{i}", i, "n", 7) for i in range(50)] + [(None, None, None, None, None, None, None)]
    docs = docs_of(spark, rows)
    taken = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    got = mixing.mixed(docs)
    assert got.columns == docs.columns
    want = [r for r in rows for _ in range(taken[r[0]])]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_empty(spark):
    assert mixing.mix(docs_of(spark, [])).collect() == []
    only_void = docs_of(spark, [(1, "a", None, "", 1, "", 2), (2, None, "", "", 1, "", 2)])
    assert sorted(tuple(r)[:5] for r in mixing.mix(only_void).collect()) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
