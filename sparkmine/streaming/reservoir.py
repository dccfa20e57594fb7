"""Uniform fixed-size sample of an endless stream of posts, with hot tags and
mean text length of the sample after every batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkmine.operators.sampling import HOT_TAGS, SAMPLE_SIZE, hot_tags, reservoir, sample_stats
from sparkmine.streaming import state

POSTS = "id BIGINT, text STRING, tags ARRAY<STRING>"
SEEN = "n_seen BIGINT"


def run_reservoir_stream(
    posts: DataFrame,
    state_path: str,
    size: int = SAMPLE_SIZE,
    seed: int = 1,
    available_now: bool = False,
    emit: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Keep the sample of all ``(id, text, tags)`` posts seen so far.

    One pass per batch: its tasks cut it to ``size`` rows and count it, and the
    rows kept so far are merged in. Nothing else is remembered but the number
    of posts, which is written last and marks the batch as done. ``emit``
    receives the hot tags and the sample figures of every batch.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = state.read(spark, state_path, "sample", batch_id - 1, POSTS)
        seen = state.read(spark, state_path, "seen", batch_id - 1, SEEN).first()
        counted = Observation()
        batch = batch.select("id", "text", "tags").observe(counted, F.count(F.lit(1)).alias("n"))
        cut = reservoir(batch, "id", size, seed).drop("prio")
        state.write(reservoir(cut.unionByName(before), "id", size, seed).drop("prio"), state_path, "sample", batch_id)
        n_seen = counted.get["n"] + (seen[0] if seen else 0)
        state.write(spark.createDataFrame([(n_seen,)], SEEN), state_path, "seen", batch_id)
        if emit:
            emit(hot_tags(read_sample(spark, state_path), HOT_TAGS), batch_id)
            emit(stream_stats(spark, state_path), batch_id)

    return state.start(posts, state_path, on_batch, available_now)


def read_sample(spark: SparkSession, state_path: str) -> DataFrame:
    """The sample as of the last finished batch."""
    return state.read(spark, state_path, "sample", state.last_batch(spark, state_path, "seen"), POSTS)


def posts_seen(spark: SparkSession, state_path: str) -> int:
    last = state.last_batch(spark, state_path, "seen")
    row = state.read(spark, state_path, "seen", last, SEEN).first()
    return row[0] if row else 0


def stream_stats(spark: SparkSession, state_path: str) -> DataFrame:
    """Posts seen, rows kept, and mean text length of the sample."""
    return sample_stats(read_sample(spark, state_path), posts_seen(spark, state_path))
