from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from sparkmine.operators import temporal
from sparkmine.streaming import windows

T0 = datetime(2024, 1, 1)
ROWS = "id BIGINT, k STRING, at TIMESTAMP, kind STRING, match STRING"


def moment(n):
    return None if n is None else T0 + timedelta(minutes=n)


def frame(spark, rows):
    return spark.createDataFrame([(i, k, moment(t), x, "m") for i, k, t, x in rows], ROWS).repartition(3)


def latest(left, right, strict, unlike):
    """One row after another."""
    out = []
    for i, k, t, x in left:
        best = None
        for j, q, u, y in right:
            if None in (k, t, q, u) or k != q or u > t or (strict and u == t) or (unlike and x == y):
                continue
            if best is None or (u, j) > best:
                best = (u, j)
        out.append((i, best and best[1]))
    return sorted(out, key=repr)


def sample(seed, n):
    """A third of the rows has one key; times repeat, some values are null."""
    rnd = random.Random(seed)
    return [(i, rnd.choice(["hot", "hot", "hot", "a", "b", "c", "d", None, "e"]), rnd.choice([None, *range(60)]) if rnd.random() < 0.5 else rnd.randint(0, 500), rnd.choice(["x", "x", "y", None])) for i in range(n)]


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("unlike", [None, "kind"])
@pytest.mark.parametrize("slices", [1, 7])
def test_asof(spark, strict, unlike, slices):
    left, right = sample(1, 250), sample(2, 120)
    left += left[:5]
    found = temporal.asof_join(frame(spark, left), frame(spark, right), ["k"], "at", strict, ["id"], unlike, "found", slices)
    assert found.columns == ["id", "k", "at", "kind", "match", "found"]
    got = sorted(((r["id"], r["found"] and r["found"]["id"]) for r in found.collect()), key=repr)
    assert got == latest(left, right, strict, unlike)
    assert sum(r[1] is not None for r in got) > 100


def test_asof_empty_sides(spark):
    rows = frame(spark, sample(3, 20))
    assert temporal.asof_join(rows, rows.limit(0), ["k"], "at", match="found").filter("found IS NULL").count() == 20
    assert temporal.asof_join(rows.limit(0), rows, ["k"], "at", match="found").count() == 0


def test_asof_spreads_a_hot_key(spark):
    """The rows of one key are sorted in slices, none with more than a few times its share."""
    rows = spark.range(20_000).select(F.col("id"), F.lit("hot").alias("k"), (F.lit(T0) + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("at"))
    cuts = temporal._bounds(rows, temporal.SLICES)
    sizes = [r["count"] for r in rows.groupBy(temporal._slice(F.col("at"), cuts).alias("s")).count().collect()]
    assert len(sizes) == temporal.SLICES and max(sizes) < 2 * 20_000 / temporal.SLICES
    plan = plan_of(temporal.asof_join(rows, rows, ["k"], "at", match="found"))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_overlap(spark):
    rnd = random.Random(5)

    def spans(n):
        out = []
        for i in range(n):
            start = rnd.choice([None, *range(-50, 50)]) if rnd.random() < 0.2 else rnd.randint(-300, 300)
            end = None if start is None or rnd.random() < 0.05 else start + rnd.choice([-3, 0, 1, 10, 30, 200])
            out.append((i, rnd.choice(["hot", "hot", "a", None]), start, end))
        return out + out[:3]

    left, right = spans(150), spans(90)
    make = lambda rows: spark.createDataFrame([(i, k, moment(s), moment(e)) for i, k, s, e in rows], "id BIGINT, k STRING, s TIMESTAMP, e TIMESTAMP")
    want = sorted((i, j) for i, k, s, e in left for j, q, t, u in right if None not in (k, q, s, e, t, u) and k == q and s < e and t < u and s < u and t < e)
    found = temporal.overlap_join(make(left), make(right), ("s", "e"), ("s", "e"), 1200, ["k"])
    assert sorted((r[0], r[1]) for r in found.select("ours.id", "theirs.id").collect()) == want and len(want) > 200
    everywhere = sorted((i, j) for i, _, s, e in left for j, _, t, u in right if None not in (s, e, t, u) and s < e and t < u and s < u and t < e)
    found = temporal.overlap_join(make(left), make(right), ("s", "e"), ("s", "e"), 1200)
    assert sorted((r[0], r[1]) for r in found.select("ours.id", "theirs.id").collect()) == everywhere
    plan = plan_of(found)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert temporal.overlap_join(make(left).limit(0), make(right), ("s", "e"), ("s", "e"), 1200).count() == 0


EVENTS = "ts TIMESTAMP, user_id BIGINT, id BIGINT"


def test_windows_are_settled_once(spark, tmp_path):
    """Started again for each part; late rows of closed windows are dropped, late rows of open ones count."""
    folder, path = str(tmp_path / "in"), str(tmp_path / "work")
    parts = [[0, 5, 61], [65, 50, 130], [20, 128, 200], [199, 140, 320]]
    dropped, newest, kept = 0, None, []
    for part in parts:
        spark.createDataFrame([(moment(t), 1, t) for t in part], EVENTS).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(EVENTS).parquet(folder)
        out = windows.windowed(stream, windows.tumbling("1 hour"), ["user_id"], "30 minutes", [F.count("*").alias("n")])
        windows.run_append(out, path, available_now=True).awaitTermination()
        mark = None if newest is None else newest - 30
        for t in part:
            late = mark is not None and (t // 60 + 1) * 60 <= mark
            dropped += late
            kept += [] if late else [t]
        newest = max(part + [newest or 0])
    closed = {}
    for t in kept:
        if (t // 60 + 1) * 60 <= newest - 30:
            closed[t // 60 * 60] = closed.get(t // 60 * 60, 0) + 1
    got = windows.read_out(spark, path).collect()
    assert sorted((r["window_start"], r["n"]) for r in got) == sorted((moment(s), n) for s, n in closed.items())
    assert dropped == 1
    still_open = windows.waiting(spark, path).select(F.col("value.*")).collect()
    assert sum(r[0] for r in still_open) == len(kept) - sum(closed.values())


def test_joined_streams_equal_the_tables(spark, tmp_path):
    rnd = random.Random(9)
    rows = sorted((rnd.randint(0, 3000), rnd.randint(0, 5), i) for i in range(400))
    left, right = rows[::2], rows[1::2]
    path = str(tmp_path / "work")
    for part in range(3):
        for name, side in (("left", left), ("right", right)):
            some = [r for r in side if r[0] // 1001 == part]
            spark.createDataFrame([(moment(t), u, i) for t, u, i in some], EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        a, b = (spark.readStream.schema(EVENTS).parquet(str(tmp_path / name)) for name in ("left", "right"))
        pairs = windows.joined_within(a, b, "user_id", "30 MINUTES", "1 hour", "ts").select(F.col("earlier.id").alias("a"), F.col("later.id").alias("b"))
        windows.run_append(pairs, path, available_now=True).awaitTermination()
    got = sorted(tuple(r) for r in windows.read_out(spark, path).collect())
    assert got == sorted((i, j) for t, u, i in left for s, v, j in right if u == v and t <= s <= t + 30) and len(got) > 20
