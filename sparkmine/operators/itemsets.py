"""Frequent itemsets: every set of items that at least ``support`` baskets hold.

Baskets come in long form ``(basket, item)``. Two exact ways, same result:

* ``levels`` keeps, per frequent item, the baskets holding it as bits: one row
  stands for a block of baskets. Sets grow by one item per level; a set's bits
  are the AND of two smaller sets' bits and its support is their bit count. A
  basket is one bit in each of its items' rows, however many items it has.
* ``fpgrowth`` hands the baskets, cut to their frequent items, to the FP-growth
  of Spark ML, which suits many frequent items in short baskets.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.plans.workspace import materialize

WORD_BITS = 64
WORDS = 8  # 64-bit words per row: one row covers 512 baskets
BLOCK = WORD_BITS * WORDS
BASKETS_PER_WINDOW = 8 * BLOCK  # baskets numbered together by one task
BLOCKS_PER_BUCKET = 1 << 20
PAIR_PARTS = 16  # join keys that the sets of one prefix are spread over
WORD_COLS = [f"w{i}" for i in range(WORDS)]


def basket_dedup(baskets: DataFrame) -> DataFrame:
    """Each item once per basket."""
    return baskets.select("basket", "item").dropDuplicates(["basket", "item"])


def basket_count(baskets: DataFrame) -> DataFrame:
    return baskets.agg(F.countDistinct("basket").alias("n_baskets"))


def frequent_items(held: DataFrame, support: int) -> DataFrame:
    """Items in at least ``support`` baskets, from de-duplicated baskets."""
    return held.groupBy("item").agg(F.count("*").alias("freq")).filter(F.col("freq") >= support)


def basket_bits(held: DataFrame, n_baskets: int) -> DataFrame:
    """De-duplicated baskets as ``(item, block, w0..)``, one bit per basket.

    Baskets are dealt into buckets by hash and numbered inside their bucket,
    so numbering needs no global order. The hash is over distinct basket ids:
    a bucket's size follows the number of baskets, not their popularity, and
    a basket adds at most one row per frequent item.
    """
    buckets = max(1, -(-n_baskets // BASKETS_PER_WINDOW))
    numbered = held.withColumn("bucket", F.pmod(F.xxhash64("basket"), F.lit(buckets).cast("bigint")))
    place = F.dense_rank().over(Window.partitionBy("bucket").orderBy("basket")) - 1
    numbered = numbered.withColumn("place", place)
    block = F.col("bucket") * BLOCKS_PER_BUCKET + F.floor(F.col("place") / BLOCK)
    word = F.floor(F.col("place") % BLOCK / WORD_BITS)
    bit = F.expr(f"shiftleft(1L, cast(place % {WORD_BITS} AS int))")
    zero = F.lit(0).cast("bigint")
    words = [F.bit_or(F.when(F.col("word") == i, F.col("bit")).otherwise(zero)).alias(c) for i, c in enumerate(WORD_COLS)]
    return (
        numbered.select("item", block.alias("block"), word.alias("word"), bit.alias("bit"))
        .groupBy("item", "block")
        .agg(*words)
    )


def _held_baskets() -> Column:
    return reduce(lambda a, b: a + b, [F.bit_count(c) for c in WORD_COLS]).cast("bigint")


def _any_bit() -> Column:
    return reduce(or_, [F.col(c) != 0 for c in WORD_COLS])


def _paired(left: DataFrame, right: DataFrame, item: str) -> DataFrame:
    """Pairs of rows of one ``prefix``. Sets of one item all have the empty prefix, so
    the left ones are dealt over parts by ``item`` and the right ones listed in each."""
    parts = F.sequence(F.lit(0), F.lit(PAIR_PARTS - 1))
    left = left.withColumn("part", F.pmod(F.xxhash64(item), F.lit(PAIR_PARTS)).cast("int"))
    return left.join(right.withColumn("part", F.explode(parts)), ["prefix", "part"]).drop("part")


def candidates(level: DataFrame) -> DataFrame:
    """Sets one item larger, joined from sets that differ in their last item.
    ``level`` holds sorted sets of one size as ``(items)``."""
    parts = level.select(_prefix().alias("prefix"), F.element_at("items", -1).alias("last"))
    right = parts.withColumnRenamed("last", "next")
    return (
        _paired(parts, right, "last")
        .filter(F.col("last") < F.col("next"))
        .select(F.concat("prefix", F.array("last", "next")).alias("items"))
    )


def _prefix() -> Column:
    return F.slice("items", F.lit(1), F.size("items") - 1)


def _grow(bits: DataFrame) -> DataFrame:
    """Bits of the sets one item larger. The join pairs sets of one prefix in
    one block of baskets, so its rows are candidate sets per block, never
    pairs per basket."""
    left = bits.select(_prefix().alias("prefix"), F.element_at("items", -1).alias("last"), "block", *WORD_COLS)
    right = left.select("prefix", F.col("last").alias("next"), "block", *[F.col(c).alias(f"r_{c}") for c in WORD_COLS])
    both = left.join(right, ["prefix", "block"]).filter(F.col("last") < F.col("next"))
    words = [F.col(c).bitwiseAND(F.col(f"r_{c}")).alias(c) for c in WORD_COLS]
    return both.select(F.concat("prefix", F.array("last", "next")).alias("items"), "block", *words).filter(_any_bit())


def _supported(bits: DataFrame, support: int) -> DataFrame:
    return bits.groupBy("items").agg(F.sum(_held_baskets()).alias("freq")).filter(F.col("freq") >= support)


def support_count(baskets: DataFrame, cands: DataFrame) -> DataFrame:
    """Baskets that hold every item of each candidate, as ``(items, freq)``;
    candidates no basket holds are left out."""
    cands = cands.select("items").distinct()
    members = cands.select("items", F.explode("items").alias("item"))
    wanted = members.select("item").distinct()
    held = materialize(basket_dedup(baskets.join(wanted, "item", "left_semi")), "held")
    bits = basket_bits(held, _about_baskets(held))
    whole = F.count("*") == F.size("items")
    return (
        members.join(bits, "item")
        .groupBy("items", "block")
        .agg(*[F.bit_and(c).alias(c) for c in WORD_COLS], whole.alias("whole"))
        .filter("whole")
        .groupBy("items")
        .agg(F.sum(_held_baskets()).alias("freq"))
        .filter("freq > 0")
    )


def _about_baskets(held: DataFrame) -> int:
    """Roughly how many baskets there are; sizes the buckets, changes no result."""
    return held.select(F.approx_count_distinct("basket")).first()[0]


def _by_levels(kept: DataFrame, singles: DataFrame, n_baskets: int, support: int, max_len: int | None) -> DataFrame:
    out = singles.select(F.array("item").alias("items"), "freq")
    bits = basket_bits(kept, n_baskets).select(F.array("item").alias("items"), "block", *WORD_COLS)
    bits = materialize(bits, "bits-1")
    size = 2
    while max_len is None or size <= max_len:
        grown = materialize(_grow(bits), f"grown-{size}")
        level = materialize(_supported(grown, support), f"level-{size}")
        if level.isEmpty():
            break
        out = out.unionByName(level)
        if size != max_len:
            bits = materialize(grown.join(level.select("items"), "items", "left_semi"), f"bits-{size}")
        size += 1
    return out


def _by_fpgrowth(kept: DataFrame, singles: DataFrame, support: int) -> DataFrame:
    # Baskets are cut to frequent items already: a list is no longer than the
    # list of frequent items.
    lists = kept.groupBy("basket").agg(F.collect_list("item").alias("items"))
    # The solver takes a share of its own rows and rounds up; half a basket
    # less keeps sets of exactly ``support`` baskets.
    n_lists = lists.count()
    if n_lists == 0:
        return singles.select(F.array("item").alias("items"), "freq")
    share = max(0.0, (support - 0.5) / n_lists)
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, share)).fit(lists)
    return model.freqItemsets.filter(F.col("freq") >= support).select(F.array_sort("items").alias("items"), "freq")


def frequent_itemsets(
    baskets: DataFrame, support: int, max_len: int | None = None, method: str = "auto"
) -> DataFrame:
    """All itemsets of up to ``max_len`` items (any size when None) held by at
    least ``support`` baskets, as ``(items, size, freq)`` with sorted items.

    The baskets are read twice: once to find the frequent items, once for the
    rows of those items, which is all that is written down. ``auto`` is
    ``levels`` where a size is given, since FP-growth would mine every larger set
    too, and else ``fpgrowth``, the faster one on all inputs measured.
    """
    if method == "auto":
        method = "fpgrowth" if max_len is None else "levels"
    singles = materialize(frequent_items(basket_dedup(baskets), support), "level-1")
    if max_len == 1:
        return singles.select(F.array("item").alias("items"), F.lit(1).alias("size"), "freq")
    kept = materialize(basket_dedup(baskets.join(singles.select("item"), "item", "left_semi")), "baskets")
    if method == "levels":
        found = _by_levels(kept, singles, _about_baskets(kept), support, max_len)
    elif method == "fpgrowth":
        found = _by_fpgrowth(kept, singles, support)
    else:
        raise ValueError(f"unknown method {method!r}")
    found = found.select("items", F.size("items").alias("size"), "freq")
    return found if max_len is None else found.filter(F.col("size") <= max_len)


def itemset_algebra(level: DataFrame) -> DataFrame:
    """For sets that share all but their last item: union, intersection,
    whether the first lies inside the union, and the union's size."""
    left = level.select(_prefix().alias("prefix"), F.col("items").alias("left"))
    right = level.select(_prefix().alias("prefix"), F.col("items").alias("right"))
    both = _paired(left, right, "left").filter(F.element_at("left", -1) < F.element_at("right", -1))
    union = F.array_sort(F.array_union("left", "right"))
    return both.select(
        "left",
        "right",
        union.alias("union"),
        F.array_intersect("left", "right").alias("common"),
        (F.size(F.array_except("left", union)) == 0).alias("is_subset"),
        F.size(union).alias("size"),
    )


def format_itemsets(sets: DataFrame) -> DataFrame:
    """Report rows ``(size, itemset)`` in order: sizes up, then the sets by
    their joined items. One row per set, so no size has to fit in one row."""
    joined = F.array_join("items", ",")
    return (
        sets.select("size", joined.alias("key"))
        .orderBy("size", "key")
        .select("size", F.concat(F.lit("("), F.col("key"), F.lit(")")).alias("itemset"))
    )
