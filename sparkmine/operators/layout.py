"""How rows spread over partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lay_out(df: DataFrame, n: int, key: str | None = None) -> DataFrame:
    """``n`` partitions, dealt evenly or hashed by ``key``."""
    return df.repartition(n, key) if key else df.repartition(n)


def key_spread(df: DataFrame, n: int, key: str) -> DataFrame:
    """How many of ``n`` partitions hashed by ``key`` hold each key, and its
    rows, as ``(key, partitions, n)``."""
    held = lay_out(df, n, key).groupBy(key, F.spark_partition_id().alias("partition_id")).agg(F.count("*").alias("n"))
    return held.groupBy(key).agg(F.count("*").alias("partitions"), F.sum("n").alias("n"))


def partition_profile(df: DataFrame, n: int, key: str | None = None) -> DataFrame:
    """Rows in each of the ``n`` partitions, as ``(layout, partition_id, n)``;
    empty partitions show 0."""
    held = (
        lay_out(df, n, key)
        .groupBy(F.spark_partition_id().cast("bigint").alias("partition_id"))
        .agg(F.count("*").alias("n"))
    )
    every = df.sparkSession.range(n).withColumnRenamed("id", "partition_id")
    return every.join(held, "partition_id", "left").select(
        F.lit("Partition" if key else "Standard").alias("layout"),
        "partition_id",
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
    )
