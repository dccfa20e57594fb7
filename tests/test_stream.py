from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from sparkmine.functions.hashing import slot
from sparkmine.operators import bloom, sampling
from sparkmine.sources import readers
from sparkmine.streaming import bloom as bloom_stream
from sparkmine.streaming import reservoir as reservoir_stream
from sparkmine.streaming.state import to_console

N = 400


def post(n: int, rng: random.Random) -> tuple:
    tags = [rng.choice("abcdefghijklmnopqrstuvwxyz") + rng.choice("xyz") for _ in range(rng.randint(0, 3))]
    if n % 3 == 0:
        tags.append("hot")
    return n, f"post {n} {'Data' if n % 4 else 'none'} " + "x" * (n % 17), tags


@pytest.fixture(scope="module")
def posts(spark):
    rng = random.Random(8)
    return spark.createDataFrame([post(n, rng) for n in range(N)], "id BIGINT, text STRING, tags ARRAY<STRING>")


def one_by_one(pairs: list[tuple[str, tuple]]) -> tuple[int, int, int]:
    """The filter as a plain loop over (tag, slots) in order."""
    on, stored, right, wrong = set(), set(), 0, 0
    for tag, bits in pairs:
        if on.issuperset(bits):
            if tag in stored:
                right += 1
            else:
                wrong += 1
        else:
            on.update(bits)
            stored.add(tag)
    return len(stored), right, wrong


def with_slots(df, m):
    rows = df.select("tag", *[slot(F.col("tag"), n) for n in m]).collect()
    return [(r[0], tuple(r[1:])) for r in rows]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("m", [(10, 30), (3, 50), (40, 1000), (7,)])
def test_bloom_score_against_plain_loop(spark, seed, m):
    rng = random.Random(seed)
    tags = [f"t{int(rng.paretovariate(0.7)) % 60}" for _ in range(300)]
    df = spark.createDataFrame([(t, p * 3 + 1) for p, t in enumerate(tags)], "tag STRING, pos BIGINT")
    want = one_by_one(with_slots(df, m))
    assert tuple(bloom.bloom_report(df.repartition(3), m=m).first()) == want
    early, late = df.filter("pos < 400"), df.filter("pos >= 400")
    merged = bloom.merge_classes(bloom.slot_classes(early, m=m), late, m)
    assert tuple(bloom.bloom_score(merged, m).first()) == want


def test_bloom_of_nothing(spark):
    df = spark.createDataFrame([], "tag STRING, pos BIGINT")
    assert tuple(bloom.bloom_report(df).first()) == (0, 0, 0)


@pytest.mark.parametrize("broadcast", [True, False])
def test_bloom_filter_has_no_false_negative(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(bloom, "BROADCAST_BITS", 0)
    members = spark.range(0, 3000, 3).withColumnRenamed("id", "k")
    n_bits = bloom.bloom_size(1000, 0.05)
    bits = bloom.bloom_build(members, "k", n_bits)
    assert bits.count() <= n_bits / 64 + 1
    kept = {r.k for r in bloom.bloom_filter(spark.range(3000).withColumnRenamed("id", "k"), "k", bits, n_bits).collect()}
    assert kept >= set(range(0, 3000, 3))
    assert len(kept) < 1000 + 2000 * 0.15


def test_bloom_filter_is_one_projection_and_keeps_repeats(spark):
    members = spark.createDataFrame([("a",), (None,), ("b",), ("a",)], "k STRING")
    bits = bloom.bloom_build(members, "k", 640)
    asked = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", 4)], "k STRING, v INT")
    kept = bloom.bloom_filter(asked, "k", bits, 640)
    assert sorted(r.v for r in kept.collect()) == [1, 2, 4]
    assert "Join" not in plan_of(kept).split("Subquery")[0]
    nothing = bloom.bloom_build(members.filter("k = 'x'"), "k", 640)
    assert bloom.bloom_filter(asked, "k", nothing, 640).count() == 0


def test_reservoir_merges_and_is_uniform(spark, posts):
    whole = {r.id for r in sampling.reservoir(posts, "id", 50, 3).collect()}
    parts = [sampling.reservoir(posts.filter(F.col("id") % 4 == p), "id", 50, 3) for p in range(4)]
    merged = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    assert {r.id for r in sampling.reservoir(merged, "id", 50, 3).collect()} == whole
    assert sampling.reservoir(posts, "id", 10 * N, 3).count() == N
    hits = [0] * 20
    small = spark.range(20)
    for seed in range(40):
        for r in sampling.reservoir(small, "id", 5, seed).collect():
            hits[r.id] += 1
    assert sum(hits) == 200 and min(hits) > 0 and max(hits) < 25


def test_hot_tags_order(spark):
    df = spark.createDataFrame([(["b", "a"],), (["a", "c", "b"],), ([],), (["d"],)], "tags ARRAY<STRING>")
    assert [tuple(r) for r in sampling.hot_tags(df, 3).collect()] == [("a", 2), ("b", 2), ("c", 1)]


def land(posts, folder, step: int, upto: int = N, since: int = 0) -> None:
    for start in range(since, upto, step):
        part = posts.filter((F.col("id") >= start) & (F.col("id") < min(start + step, upto)))
        part.coalesce(1).withColumn("ts", F.lit(None).cast("timestamp")).write.mode("append").parquet(folder)


def run_both(spark, folder, state):
    stream = readers.read_posts_stream(spark, folder, files_per_batch=1)
    reservoir_stream.run_reservoir_stream(stream, f"{state}/r", 30, 5, available_now=True).awaitTermination()
    tags = bloom_stream.tag_positions(readers.read_posts_stream(spark, folder, files_per_batch=1))
    bloom_stream.run_bloom_stream(tags, f"{state}/b", available_now=True).awaitTermination()


@pytest.mark.parametrize("steps", [[(N, N)], [(100, N)], [(130, 200), (60, N)]])
def test_streams_equal_batch_however_posts_arrive(spark, posts, tmp_path, steps):
    """One batch, several batches, and a stop between files give one result."""
    folder, state, since = str(tmp_path / "in"), str(tmp_path / "state"), 0
    for step, upto in steps:
        land(posts, folder, step, upto, since)
        run_both(spark, folder, state)
        since = upto
    want = sampling.reservoir(posts, "id", 30, 5)
    got = reservoir_stream.read_sample(spark, f"{state}/r")
    assert {r.id for r in got.collect()} == {r.id for r in want.collect()}
    assert tuple(reservoir_stream.stream_stats(spark, f"{state}/r").first()) == tuple(
        sampling.sample_stats(want, N).first()
    )
    ordered = bloom_stream.tag_positions(posts).orderBy("pos")
    assert tuple(bloom_stream.read_score(spark, f"{state}/b").first()) == one_by_one(with_slots(ordered, (10, 30)))


def test_batches_are_reported(spark, posts, tmp_path, capsys):
    folder = str(tmp_path / "in")
    land(posts, folder, N)
    stream = readers.read_posts_stream(spark, folder, track="data")
    seen = []

    def emit(df, batch_id):
        to_console(df, batch_id)
        seen.append((batch_id, df.columns))

    reservoir_stream.run_reservoir_stream(
        stream, str(tmp_path / "r"), available_now=True, emit=emit
    ).awaitTermination()
    assert seen == [(0, ["tag", "n"]), (0, ["n_seen", "n_sample", "avg_length"])]
    assert reservoir_stream.posts_seen(spark, str(tmp_path / "r")) == N - N // 4
    assert "hot" in capsys.readouterr().out


def test_a_batch_run_again_leaves_the_same_state(spark, posts, tmp_path):
    path = str(tmp_path / "b")
    stream = bloom_stream.tag_positions(posts)
    from sparkmine.streaming import state

    schema = bloom_stream.classes_schema("STRUCT<id: BIGINT, ordinal: INT>")
    for batch_id, part in [(0, stream.filter("pos.id < 100")), (1, stream.filter("pos.id >= 100"))]:
        for _ in range(2):  # second run of the same batch
            before = state.read(spark, path, "classes", batch_id - 1, schema)
            state.write(bloom.merge_classes(before, part), path, "classes", batch_id)
    want = tuple(bloom.bloom_report(stream).first())
    assert tuple(bloom_stream.read_score(spark, path).first()) == want


def test_order_of_arrival_counts_and_ids_may_be_large(spark, tmp_path):
    """Later batches with smaller ids, ids of 19 digits, tags in the text."""
    rng = random.Random(3)
    posts = [(1067094924124872705 - n, " ".join(f"#{rng.choice('abcdefgh')}é" for _ in range(5)) + " data") for n in range(60)]
    folder, path, seen = tmp_path / "in", str(tmp_path / "s"), []
    for upto in (20, 40, 60):
        part = sorted(posts[upto - 20 : upto])
        spark.createDataFrame(part, "id BIGINT, text STRING").coalesce(1).write.mode("append").parquet(str(folder))
        stream = readers.read_posts_stream(spark, str(folder), schema="id BIGINT, text STRING", track="data")
        bloom_stream.run_bloom_stream(bloom_stream.tag_positions(stream), path, available_now=True).awaitTermination()
        seen += [t[1:] for _, text in part for t in text.split() if t.startswith("#")]
    tags = with_slots(spark.createDataFrame([(t,) for t in seen], "tag STRING"), (10, 30))
    assert tuple(bloom_stream.read_score(spark, path).first()) == one_by_one(tags)


def test_lost_state_stops_the_stream(spark, tmp_path):
    from sparkmine.streaming import state

    assert state.read(spark, str(tmp_path), "seen", -1, "n BIGINT").count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        state.read(spark, str(tmp_path / "gone"), "seen", 5, "n BIGINT")
    state.write(spark.createDataFrame([(1,)], "n BIGINT"), str(tmp_path), "seen", 3)
    with pytest.raises(RuntimeError, match="batch 3"):
        state.read(spark, str(tmp_path), "seen", 5, "n BIGINT")
