from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from sparkmine.operators import itemsets
from sparkmine.sources import sinks

SCHEMA = "basket STRING, item STRING"


def brute_force(baskets: dict[str, set], support: int) -> dict[tuple, int]:
    found, size = {}, 1
    while True:
        counts = Counter(c for items in baskets.values() for c in combinations(sorted(items), size))
        level = {s: n for s, n in counts.items() if n >= support}
        if not level:
            return found
        found.update(level)
        size += 1


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(2)
    baskets = {f"b{n}": {f"i{k}" for k in range(9) if rng.random() < 0.9 - k * 0.07} for n in range(700)}
    pairs = [(b, i) for b, items in baskets.items() for i in items]
    pairs += pairs[::5]  # repeated items
    return baskets, spark.createDataFrame(pairs, SCHEMA)


@pytest.mark.parametrize("method", ["levels", "fpgrowth", "auto"])
def test_all_sizes_against_brute_force(case, method):
    baskets, df = case
    want = brute_force(baskets, 150)
    got = {tuple(r["items"]): r.freq for r in itemsets.frequent_itemsets(df, 150, method=method).collect()}
    assert max(map(len, want)) >= 4
    assert got == want
    for found in got:
        for sub in combinations(found, len(found) - 1):
            assert not sub or got[sub] >= got[found]


def test_exact_threshold_is_kept(spark):
    pairs = [(f"b{n}", "x") for n in range(7)] + [(f"c{n}", "y") for n in range(18)]
    df = spark.createDataFrame(pairs, SCHEMA)
    for method in ("levels", "fpgrowth"):
        got = {tuple(r["items"]): r.freq for r in itemsets.frequent_itemsets(df, 7, method=method).collect()}
        assert got == {("x",): 7, ("y",): 18}


def test_nothing_frequent(spark):
    df = spark.createDataFrame([("a", "x")], SCHEMA)
    for method in ("levels", "fpgrowth"):
        assert itemsets.frequent_itemsets(df, 2, method=method).count() == 0


def test_one_basket_with_a_third_of_all_rows(spark):
    """A basket is one bit per item however large it is."""
    pairs = [("hot", f"i{n}") for n in range(3000)] + [(f"b{n}", f"i{n % 3}") for n in range(3000)]
    pairs += [(f"b{n}", f"i{(n + 1) % 3}") for n in range(3000)]
    df = spark.createDataFrame(pairs, SCHEMA)
    got = {tuple(r["items"]): r.freq for r in itemsets.frequent_itemsets(df, 900, method="levels").collect()}
    assert got[("i0",)] == 2001 and got[("i0", "i1")] == 1001 and len(got) == 6


def test_max_len_and_candidates(case, spark, rows):
    baskets, df = case
    pairs = itemsets.frequent_itemsets(df, 150, max_len=2)
    assert {r.size for r in pairs.collect()} == {1, 2}
    level = spark.createDataFrame([(["a", "b"],), (["a", "c"],), (["b", "c"],)], "items ARRAY<STRING>")
    assert rows(itemsets.candidates(level)) == [(["a", "b", "c"],)]
    algebra = itemsets.itemset_algebra(level).collect()
    assert [(r.union, r.common, r.is_subset, r.size) for r in algebra] == [(["a", "b", "c"], ["a"], True, 3)]


def test_support_of_given_candidates(case, spark):
    baskets, df = case
    sets = [("i0", "i1"), ("i2", "i5", "i8"), ("i0", "nowhere"), ("i7",)]
    cands = spark.createDataFrame([(list(s),) for s in sets], "items ARRAY<STRING>")
    want = {s: sum(set(s) <= items for items in baskets.values()) for s in sets}
    got = {tuple(r["items"]): r.freq for r in itemsets.support_count(df, cands).collect()}
    assert got == {s: n for s, n in want.items() if n}


def test_bits_spill_into_further_blocks(spark):
    df = spark.createDataFrame([(f"b{n}", "x") for n in range(3 * itemsets.BLOCK + 5)], SCHEMA)
    bits = itemsets.basket_bits(df, 1)  # one bucket for all baskets
    assert bits.count() == 4
    assert bits.selectExpr("sum(" + " + ".join(f"bit_count({c})" for c in itemsets.WORD_COLS) + ")").first()[0] == 3 * 512 + 5


def test_report(spark, tmp_path):
    sets = spark.createDataFrame(
        [(["b"], 1, 3), (["a", "c"], 2, 2), (["a"], 1, 4), (["a", "b"], 2, 2)], "items ARRAY<STRING>, size INT, freq BIGINT"
    )
    lines = [(r.size, r.itemset) for r in itemsets.format_itemsets(sets).collect()]
    assert lines == [(1, "(a)"), (1, "(b)"), (2, "(a,b)"), (2, "(a,c)")]
    sinks.write_itemsets(sets, str(tmp_path / "sets"))
    assert [r.value for r in spark.read.text(str(tmp_path / "sets" / "size=2")).collect()] == ["(a,b)", "(a,c)"]


def test_counts(case, rows):
    baskets, df = case
    assert itemsets.basket_count(df).first()[0] == sum(1 for i in baskets.values() if i)
    assert itemsets.basket_dedup(df).count() == sum(map(len, baskets.values()))


def test_single_items_are_paired_over_many_keys(spark):
    """Sets of one item share the empty prefix; no task gets them all."""
    level = spark.createDataFrame([([f"i{k:03d}"],) for k in range(200)], "items ARRAY<STRING>")
    found = itemsets.candidates(level)
    assert found.count() == 200 * 199 // 2 == found.distinct().count()
    left = level.select(F.pmod(F.xxhash64(F.element_at("items", -1)), F.lit(itemsets.PAIR_PARTS)).alias("part"))
    sizes = [r["count"] for r in left.groupBy("part").count().collect()]
    assert len(sizes) == itemsets.PAIR_PARTS and max(sizes) < 40
    assert "part" in plan_of(found)


def test_a_given_size_mines_no_larger_sets(spark, monkeypatch):
    monkeypatch.setattr(itemsets, "_by_fpgrowth", None)
    df = spark.createDataFrame([(b, i) for b in range(20) for i in "abcdefghij"], "basket BIGINT, item STRING")
    grown = []
    monkeypatch.setattr(itemsets, "_grow", lambda bits, f=itemsets._grow: grown.append(1) or f(bits))
    assert itemsets.frequent_itemsets(df, 20, max_len=2).count() == 10 + 45 and len(grown) == 1
