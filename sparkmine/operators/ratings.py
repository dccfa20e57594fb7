"""Rating tables: clean-up, profiles, id numbers, and evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.plans.workspace import materialize

BUCKETS = 5  # absolute errors [0,1) [1,2) [2,3) [3,4) [4,inf)
PARTITION_SHIFT = 33  # row-number bits below the partition number in generated row ids


def dedup_last(df: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """One row per key, holding the value with the highest order key.

    An aggregate rather than a ranking window: repeated keys collapse on the
    map side, so one hot key costs no more than any other.
    """
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(value))


def mean_by(df: DataFrame, key: str, value: str = "rating", out: str = "avg_rating") -> DataFrame:
    return df.groupBy(key).agg(F.avg(value).alias(out))


def index_ids(df: DataFrame, col: str) -> DataFrame:
    """Number the distinct ids 0, 1, 2, ... in id order, as ``(id, idx)``.

    Sorted in range partitions; each row's number is its place inside its
    partition plus the rows of the partitions before it. Only the partition
    sizes (one row per partition) are broadcast.
    """
    ids = df.select(F.col(col).alias("id")).filter(F.col("id").isNotNull()).distinct()
    placed = ids.orderBy("id").withColumn("place", F.monotonically_increasing_id())
    # The sort samples its ranges, so its outcome is written down before use.
    placed = materialize(placed, "ids").withColumn("part", F.shiftright("place", PARTITION_SHIFT))
    sizes = placed.groupBy("part").agg(F.count("*").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    in_part = F.col("place").bitwiseAND(F.lit((1 << PARTITION_SHIFT) - 1))
    return placed.join(F.broadcast(offsets), "part").select("id", (F.col("offset") + in_part).alias("idx"))


def cold_start_class(test: DataFrame, train: DataFrame) -> DataFrame:
    """Test pairs with flags telling whether user and item occur in training."""
    users = train.select("user_id").distinct().withColumn("known_user", F.lit(True))
    items = train.select("item_id").distinct().withColumn("known_item", F.lit(True))
    return (
        test.join(users, "user_id", "left")
        .join(items, "item_id", "left")
        .select(
            "user_id",
            "item_id",
            F.coalesce("known_user", F.lit(False)).alias("known_user"),
            F.coalesce("known_item", F.lit(False)).alias("known_item"),
        )
    )


def join_predictions(actual: DataFrame, pred: DataFrame) -> DataFrame:
    """Actual ratings beside their predictions; pairs without one vanish."""
    return actual.select("user_id", "item_id", "rating").join(
        pred.select("user_id", "item_id", "prediction"), ["user_id", "item_id"]
    )


def _error() -> Column:
    return F.col("rating") - F.col("prediction")


def error_histogram(pred: DataFrame) -> DataFrame:
    """Predictions per absolute-error bucket; empty buckets show 0."""
    bucket = F.least(F.floor(F.abs(_error())), F.lit(BUCKETS - 1).cast("bigint"))
    counts = pred.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    every = pred.sparkSession.range(BUCKETS).withColumnRenamed("id", "bucket")
    return every.join(counts, "bucket", "left").select(
        "bucket", F.coalesce("n", F.lit(0).cast("bigint")).alias("n")
    )


def rmse(pred: DataFrame) -> DataFrame:
    return pred.agg(F.sqrt(F.avg(_error() * _error())).alias("rmse"))


def evaluate(pred: DataFrame) -> DataFrame:
    """Bucket counts and error figure together, as ``(measure, value)`` rows."""
    buckets = error_histogram(pred).select(
        F.format_string("errors_from_%d", F.col("bucket")).alias("measure"), F.col("n").cast("double").alias("value")
    )
    return buckets.unionByName(rmse(pred).select(F.lit("rmse").alias("measure"), F.col("rmse").alias("value")))
