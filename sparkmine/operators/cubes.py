"""Totals over every grouping of some dimensions, and sketches that merge.

Both start from the finest grouping: rows are read and summed once, and the coarser
groupings are worked out from the far fewer rows of the finest one. The finest grouping
is summed on the map side, so no group meets whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sketch settings: 2^LG_DISTINCT slots, KLL_K values a level, TOP_SLOTS counters.
LG_DISTINCT = 12
KLL_K = 400
TOP_SLOTS = 10_000
DISTINCT_ERROR = 0.05  # three times 1.04 / sqrt(2^LG_DISTINCT)
RANK_ERROR = 0.02


def _merged(sums: dict[str, Column], counts: Sequence[str]) -> list[Column]:
    return [F.sum(name).alias(name) for name in [*sums, *counts]]


def _finest(rows: DataFrame, dims: dict[str, Column], sums: dict[str, Column], count: str) -> DataFrame:
    keyed = rows.select(*[c.alias(name) for name, c in dims.items()], *[c.alias(name) for name, c in sums.items()])
    return keyed.groupBy(*dims).agg(*[F.sum(name).alias(name) for name in sums], F.count("*").alias(count))


def cube(rows: DataFrame, dims: dict[str, Column], sums: dict[str, Column], count: str = "n") -> DataFrame:
    """Sums and row counts for every subset of ``dims``. ``grouping`` has a bit for each
    dimension that is summed over, the first one highest, so a null value of a dimension
    and its total stay apart. No rows: no groups, except the grand total of none."""
    return _finest(rows, dims, sums, count).cube(*dims).agg(F.grouping_id().alias("grouping"), *_merged(sums, [count]))


def rollup(rows: DataFrame, dims: dict[str, Column], sums: dict[str, Column], count: str = "n") -> DataFrame:
    """As ``cube``, for the leading parts of ``dims`` only."""
    return _finest(rows, dims, sums, count).rollup(*dims).agg(F.grouping_id().alias("grouping"), *_merged(sums, [count]))


def grouping_sets(rows: DataFrame, dims: dict[str, Column], sets: Sequence[Sequence[str]], sums: dict[str, Column], count: str = "n") -> DataFrame:
    """As ``cube``, for the named subsets of ``dims``."""
    finest = _finest(rows, dims, sums, count)
    groups = [[finest[d] for d in chosen] for chosen in sets]
    return finest.groupingSets(groups, *[finest[d] for d in dims]).agg(F.grouping_id().alias("grouping"), *_merged(sums, [count]))


def sketched(rows: DataFrame, keys: Sequence[str], distinct: str, number: str, item: str) -> DataFrame:
    """Per group three sketches as columns, of bounded size whatever the group holds:
    ``distincts`` of one column, ``quantiles`` of a whole number, ``tops`` of an item.
    Nulls are not counted. The table can be written and merged later."""
    return rows.groupBy(*keys).agg(
        F.hll_sketch_agg(distinct, LG_DISTINCT).alias("distincts"),
        F.kll_sketch_agg_bigint(number, KLL_K).alias("quantiles"),
        F.expr(f"approx_top_k_accumulate(`{item}`, {TOP_SLOTS})").alias("tops"),
        F.count("*").alias("n"),
    )


def merged(sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The sketches of coarser groups, from those of finer ones alone."""
    return sketches.groupBy(*keys).agg(
        F.hll_union_agg("distincts").alias("distincts"),
        F.kll_merge_agg_bigint("quantiles").alias("quantiles"),
        F.expr(f"approx_top_k_combine(tops, {TOP_SLOTS})").alias("tops"),
        F.sum("n").alias("n"),
    )


def estimates(sketches: DataFrame, shares: Sequence[float], k: int) -> DataFrame:
    """Distinct count, quantiles at ``shares`` and the ``k`` most frequent items."""
    others = [c for c in sketches.columns if c not in ("distincts", "quantiles", "tops")]
    return sketches.select(
        *others,
        F.hll_sketch_estimate("distincts").alias("n_distinct"),
        F.kll_sketch_get_quantile_bigint("quantiles", F.array(*map(F.lit, shares))).alias("at_shares"),
        F.expr(f"approx_top_k_estimate(tops, {k})").alias("most"),
    )
