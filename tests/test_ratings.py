from __future__ import annotations

import math
import random
from itertools import combinations

import pytest

from conftest import plan_of
from sparkmine.operators import als, item_knn, ratings
from sparkmine.plans.skew import top_k
from pyspark.sql import functions as F

SCHEMA = "user_id BIGINT, item_id BIGINT, rating DOUBLE"


def random_ratings(seed: int, users: int, items: int, heavy: int) -> tuple[dict, dict]:
    """Training and test pairs; the first ``heavy`` users rate nearly all items."""
    rng = random.Random(seed)
    train, test = {}, {}
    for u in range(users):
        share = 0.85 if u < heavy else 0.3
        for i in range(items):
            roll = rng.random()
            if roll < share and u % 7 != 6 and i % 9 != 8:
                train[u, i] = float(rng.randint(1, 5))
            elif roll > 0.8:
                test[u, i] = float(rng.randint(1, 5))
    known = [p for p in train if rng.random() < 0.1]
    test.update({p: 3.0 for p in known})  # targets inside the user's own history
    return train, test


def pearson(train: dict, i: int, j: int) -> tuple[int, float]:
    users = [u for (u, x) in train if x == i and (u, j) in train]
    n = len(users)
    x, y = [train[u, i] for u in users], [train[u, j] for u in users]
    cov = n * sum(a * b for a, b in zip(x, y)) - sum(x) * sum(y)
    vx, vy = n * sum(a * a for a in x) - sum(x) ** 2, n * sum(b * b for b in y) - sum(y) ** 2
    return n, (round(cov / math.sqrt(vx * vy), 12) if cov and vx and vy else 0.0)


def predict_all(train: dict, test: dict, k: int) -> tuple[dict, dict]:
    by_user, by_item, memo = {}, {}, {}
    for (u, i), r in train.items():
        by_user.setdefault(u, {})[i] = r
        by_item.setdefault(i, []).append(r)
    near, pred = {}, {}
    for u, i in test:
        if u in by_user and i in by_item:
            ranked = []
            for j in by_user[u]:
                key = (min(i, j), max(i, j))
                if key not in memo:
                    memo[key] = pearson(train, *key)[1]
                ranked.append((-memo[key], j))
            best = [(j, -w) for w, j in sorted(ranked)[:k]]
            near[u, i] = {(j, w, place + 1) for place, (j, w) in enumerate(best) if w}
            num = sum(by_user[u][j] * w for j, w in best)
            den = sum(abs(w) for _, w in best)
            if abs(num) > 1e-9 and den > 1e-9:
                pred[u, i] = num / den
                continue
        if u in by_user:
            pred[u, i] = sum(by_user[u].values()) / len(by_user[u])
        elif i in by_item:
            pred[u, i] = sum(by_item[i]) / len(by_item[i])
        else:
            pred[u, i] = 3.0
    return near, pred


@pytest.fixture(scope="module")
def case(spark):
    train, test = random_ratings(5, 24, 22, 3)

    def frame(pairs):
        return spark.createDataFrame([(u, i, r) for (u, i), r in pairs.items()], SCHEMA)

    return train, test, frame(train), frame(test)


@pytest.mark.parametrize("light", [1000, 8, 2, 0])
def test_pearson_against_brute_force(case, light):
    train, _, df, _ = case
    items = sorted({i for _, i in train})
    want = {(i, j): pearson(train, i, j) for i, j in combinations(items, 2)}
    want = {p: v for p, v in want.items() if v[0] > 1}
    light = max(light, 1)
    got = {(r.item_a, r.item_b): (r.n_co, r["corr"]) for r in item_knn.item_pearson(df, light).collect()}
    assert got.keys() == want.keys()
    for p, (n, c) in want.items():
        assert got[p][0] == n and got[p][1] == pytest.approx(c, abs=1e-11)


def test_targets_restrict_pairs(case, spark):
    train, _, df, _ = case
    targets = spark.createDataFrame([(3,), (5,)], "item_id BIGINT")
    whole = {(r.item_a, r.item_b): r["corr"] for r in item_knn.item_pearson(df).collect()}
    part = {(r.item_a, r.item_b): r["corr"] for r in item_knn.item_pearson(df, targets=targets).collect()}
    assert part == {p: c for p, c in whole.items() if {3, 5} & set(p)}


@pytest.mark.parametrize("light, k", [(1000, 10), (6, 10), (6, 3), (1000, 25)])
def test_neighbours_and_predictions_against_brute_force(case, light, k):
    train, test, train_df, test_df = case
    near, pred = predict_all(train, test, k)
    corr = item_knn.item_pearson(train_df, light)
    got = {}
    for r in item_knn.neighbours(test_df, train_df, corr, k, light).collect():
        got.setdefault((r.user_id, r.item_id), set()).add((r.neighbour, r["corr"], r["rank"]))
    assert got == {p: n for p, n in near.items() if n}
    out = item_knn.item_knn_predict(train_df, test_df, k, light=light).collect()
    assert len(out) == len(test)
    for r in out:
        assert r.prediction == pytest.approx(pred[r.user_id, r.item_id], abs=1e-6)


def test_one_user_with_a_third_of_all_ratings(spark):
    """Nobody else shares two items with the hot user: no pair is written."""
    hot = [(0, i, float(i % 5 + 1)) for i in range(400)]
    rest = [(1 + i, i, 4.0) for i in range(400)]
    df = spark.createDataFrame(hot + rest, SCHEMA)
    assert item_knn.item_pearson(df, light=50).count() == 0
    test = spark.createDataFrame([(0, 401, 1.0), (5, 4, 2.0), (900, 7, 2.0), (901, 999, 2.0)], SCHEMA)
    got = {(r.user_id, r.item_id): r.prediction for r in item_knn.item_knn_predict(df, test, light=50).collect()}
    assert got[0, 401] == 3.0 and got[5, 4] == 4.0 and got[900, 7] == 3.5 and got[901, 999] == 3.0


def test_last_rating_wins(spark, rows):
    df = spark.createDataFrame([(1, 1, 2.0, 1), (1, 1, 5.0, 3), (1, 1, 4.0, 2), (1, 2, 1.0, 0)], SCHEMA + ", o INT")
    assert rows(ratings.dedup_last(df, ["user_id", "item_id"], "rating", ["o"])) == [(1, 1, 5.0), (1, 2, 1.0)]


def test_ids_are_numbered_in_order(spark):
    ids = [f"u{n:04d}" for n in range(500)]
    df = spark.createDataFrame([(i,) for i in ids + ids[::3] + [None]], "user STRING").repartition(7)
    got = sorted((r.idx, r.id) for r in ratings.index_ids(df, "user").collect())
    assert got == list(enumerate(ids))


def test_evaluation(spark, rows):
    pred = spark.createDataFrame(
        [(5.0, 4.5), (5.0, 4.0), (1.0, 5.0), (1.0, 9.0), (2.0, 2.0)], "rating DOUBLE, prediction DOUBLE"
    )
    assert rows(ratings.error_histogram(pred)) == [(0, 2), (1, 1), (2, 0), (3, 0), (4, 2)]
    assert ratings.rmse(pred).first()[0] == pytest.approx(math.sqrt((0.25 + 1 + 16 + 64) / 5))
    assert {r.measure: r.value for r in ratings.evaluate(pred).collect()}["errors_from_4"] == 2


def test_duplicate_actual_pairs_multiply(spark):
    actual = spark.createDataFrame([(1, 1, 2.0), (1, 1, 3.0), (2, 2, 1.0)], SCHEMA)
    pred = spark.createDataFrame([(1, 1, 2.5)], "user_id BIGINT, item_id BIGINT, prediction DOUBLE")
    assert ratings.join_predictions(actual, pred).count() == 2


def test_als_beats_the_global_mean_on_planted_factors(spark):
    rng = random.Random(3)
    p = [(rng.uniform(0.5, 2), rng.uniform(0.2, 1)) for _ in range(40)]
    q = [(rng.uniform(0.5, 2), rng.uniform(0.2, 1)) for _ in range(30)]
    full = [(f"u{u}", f"i{i}", p[u][0] * q[i][0] + p[u][1] * q[i][1]) for u in range(40) for i in range(30)]
    rng.shuffle(full)
    schema = "user_id STRING, item_id STRING, rating DOUBLE"
    cold = [("new", "i1", 3.0), ("u1", "new", 3.0)]
    train, test = spark.createDataFrame(full[:900], schema), spark.createDataFrame(full[900:] + cold, schema)
    pred = als.als_predict(train, test, iters=10, reg=0.01)
    mean = sum(r for *_, r in full[:900]) / 900
    base = math.sqrt(sum((r - mean) ** 2 for *_, r in full[900:]) / 300)
    out = pred.collect()
    assert len(out) == 300
    assert math.sqrt(sum((r.rating - r.prediction) ** 2 for r in out) / 300) < base / 2


def test_top_k_cuts_groups_on_the_map_side(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 2)
    cut = top_k(df, ["g"], [F.desc("id")], 3)
    assert plan_of(cut).count("WindowGroupLimit") == 2
    assert cut.count() == 6


@pytest.mark.parametrize("scale, offset", [(1e-6, 0.0), (1.0, 0.0), (0.1, 0.33), (1.0, 1e5)])
def test_correlation_and_prediction_follow_scale_and_offset(spark, scale, offset):
    rng = random.Random(6)
    base = [(u, i, rng.randint(1, 5)) for u in range(40) for i in range(12) if rng.random() < 0.6]
    plain = spark.createDataFrame([(u, i, float(r)) for u, i, r in base], "user_id INT, item_id INT, rating DOUBLE")
    other = plain.withColumn("rating", F.col("rating") * scale + offset)
    want = {(r.item_a, r.item_b): r.corr for r in item_knn.item_pearson(plain).collect()}
    got = {(r.item_a, r.item_b): r.corr for r in item_knn.item_pearson(other).collect()}
    assert got == pytest.approx(want, abs=1e-5)
    if not offset:
        test = spark.createDataFrame([(u, i, 1.0) for u in range(41) for i in range(12)], "user_id INT, item_id INT, rating DOUBLE")
        a = {(r.user_id, r.item_id): r.prediction for r in item_knn.item_knn_predict(plain, test, default=3.0).collect()}
        b = {(r.user_id, r.item_id): r.prediction / scale for r in item_knn.item_knn_predict(other, test, default=3.0 * scale).collect()}
        assert b == pytest.approx(a, rel=1e-6)


def test_item_with_equal_fractional_ratings(spark):
    """5,000 users give one item 4.3: it correlates with nothing."""
    rows = [(u, i, 4.3 if i else 0.1 * (u % 7)) for u in range(5000) for i in (0, 1)]
    train = spark.createDataFrame(rows, "user_id INT, item_id INT, rating DOUBLE")
    assert [r.corr for r in item_knn.item_pearson(train).collect()] == [0.0]


def test_pairs_meet_packed(case):
    """Pairs are summed where the raters of an item meet, and none is sent there on its own."""
    plan = plan_of(item_knn.co_rating_sums(case[2]))
    assert "hashpartitioning(i#" in plan and "hashpartitioning(item_a" not in plan and "hashpartitioning(user_id#" in plan


@pytest.mark.parametrize("hot, wanted", [(0, None), (3, None), (3, [2, 3, 5]), (0, [5])])
def test_hot_items_are_summed_pair_by_pair(case, spark, hot, wanted):
    targets = None if wanted is None else spark.createDataFrame([(i,) for i in wanted], "item_id BIGINT")
    want = sorted(map(tuple, item_knn.co_rating_sums(case[2], targets=targets).collect()))
    assert want and sorted(map(tuple, item_knn.co_rating_sums(case[2], targets=targets, hot=hot).collect())) == want
