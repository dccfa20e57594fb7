"""Fixed-size uniform samples and the figures kept over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.functions.hashing import priority

# Rows kept, and tags listed.
SAMPLE_SIZE = 100
HOT_TAGS = 5


def reservoir(df: DataFrame, id_col: str, size: int = SAMPLE_SIZE, seed: int = 1) -> DataFrame:
    """Uniform sample of ``size`` rows: those with the smallest seeded hash.

    The choice depends on the ids alone, so samples of parts merge into the
    sample of the whole, in any order and after any retry. Each task keeps
    ``size`` rows at most.
    """
    return df.withColumn("prio", priority(seed, id_col)).orderBy("prio", id_col).limit(size)


def sample_stats(sample: DataFrame, n_seen: int) -> DataFrame:
    """Rows seen, rows kept, and mean text length of the kept rows."""
    return sample.agg(
        F.lit(n_seen).cast("bigint").alias("n_seen"),
        F.count("*").alias("n_sample"),
        F.avg(F.length("text")).alias("avg_length"),
    )


def hot_tags(sample: DataFrame, n: int = HOT_TAGS) -> DataFrame:
    """The ``n`` most frequent tags of the kept rows; ties by tag."""
    return (
        sample.select(F.explode("tags").alias("tag"))
        .groupBy("tag")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "tag")
        .limit(n)
    )
