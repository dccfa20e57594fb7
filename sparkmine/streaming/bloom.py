"""The "seen before" score of the small Bloom filter over a stream of posts,
cumulative after every batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkmine.functions.hashing import SMALL_FILTER_SLOTS
from sparkmine.functions.text import hashtags
from sparkmine.operators.bloom import bloom_score, merge_classes
from sparkmine.streaming import state



def classes_schema(pos: str) -> str:
    return f"bits ARRAY<BIGINT>, first_tag STRING, first_pos {pos}, n_first BIGINT, n_all BIGINT"


CLASSES = classes_schema("BIGINT")


def tag_positions(posts: DataFrame) -> DataFrame:
    """One row per tag of a post, with a position that is unique in its batch:
    post id, then place in the post. Posts without a column ``tags`` carry them
    in their text."""
    tags = F.col("tags") if "tags" in posts.columns else hashtags("text")
    each = posts.select("id", F.posexplode(tags).alias("ordinal", "tag"))
    return each.select("tag", F.struct("id", "ordinal").alias("pos"))


def run_bloom_stream(
    tags: DataFrame,
    state_path: str,
    m: tuple[int, ...] = SMALL_FILTER_SLOTS,
    available_now: bool = False,
    emit: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Score all ``(tag, pos)`` rows seen so far in order of arrival: by batch,
    and inside a batch by ``pos``, which must be unique there.

    The state is one row per class of tags sharing their slots, so its size
    depends on the filter and not on the number of tags. Each batch is summed
    per tag on the map side and merged into it.
    """

    schema = classes_schema(_arrival(tags))

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        before = state.read(batch.sparkSession, state_path, "classes", batch_id - 1, schema)
        arrival = F.struct(F.lit(batch_id).cast("bigint").alias("batch"), "pos")
        state.write(merge_classes(before, batch.select("tag", arrival.alias("pos")), m), state_path, "classes", batch_id)
        if emit:
            emit(bloom_score(state.read(batch.sparkSession, state_path, "classes", batch_id, schema), m), batch_id)

    return state.start(tags, state_path, on_batch, available_now)


def read_score(spark: SparkSession, state_path: str, m: tuple[int, ...] = SMALL_FILTER_SLOTS) -> DataFrame:
    """Score as of the last finished batch."""
    last = state.last_batch(spark, state_path, "classes")
    if last < 0:
        return bloom_score(spark.createDataFrame([], CLASSES), m)
    return bloom_score(state.read(spark, state_path, "classes", last, state.schema_of(spark, state_path, "classes", last)), m)


def _arrival(tags: DataFrame) -> str:
    return f"STRUCT<batch: BIGINT, pos: {tags.schema['pos'].dataType.simpleString()}>"
