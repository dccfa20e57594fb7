"""Bounded group sizes for keys that hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def chunk_of(value: Column, n_chunks: Column) -> Column:
    """Deterministic chunk number of ``value`` among ``n_chunks``."""
    return F.pmod(F.xxhash64(value), n_chunks)


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows per group.

    The ``<= k`` filter on a ranking window makes Spark cut every group to
    ``k`` rows on the map side, so a hot group never meets in one task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)
