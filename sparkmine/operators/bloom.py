"""Bloom filters: a "seen before" score over a stream of tags, and a reusable
build / probe pair.

The score needs no sequential pass and no list of all tags. Tags that fall on
the same slots form a class:

* bits are only switched on, and a tag that finds its bits on adds none, so
  the bits on before some position are the bits of all tags before it;
* the first tag of a class therefore switches the class on, and every other tag
  of the class, coming later, finds its bits on and is a false positive;
* the first tag itself is stored unless other classes had switched both of its
  bits on before.

So a class is described by its first tag, that tag's position and count, and
the count of all its tags. There are at most as many classes as combinations of
slots, however many tags there are, and descriptions of parts merge.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.functions.hashing import SMALL_FILTER_SLOTS, slot, text_hash

WORD_BITS = 64
PROBES = 3  # bit positions per value in the reusable filter
BROADCAST_BITS = 1 << 27  # largest filter that is broadcast, 16 MiB of bits


def bloom_bits(df: DataFrame, col: str, m: tuple[int, ...] = SMALL_FILTER_SLOTS) -> DataFrame:
    """Add ``bits``: the slot of each bit function, all in one shared array."""
    return df.withColumn("bits", F.array(*[slot(F.col(col), n) for n in m]))


def _tag_rows(df: DataFrame, tag: str, pos: str) -> DataFrame:
    one = F.lit(1).cast("bigint")
    return df.select(F.col(tag).alias("tag"), F.col(pos).alias("first_pos"), one.alias("n"), one.alias("n_all"))


def slot_classes(
    df: DataFrame, tag: str = "tag", pos: str = "pos", m: tuple[int, ...] = SMALL_FILTER_SLOTS
) -> DataFrame:
    """Describe each class of tags as ``(bits, first_tag, first_pos, n_first,
    n_all)``."""
    return _classes(_tag_rows(df, tag, pos), m)


def merge_classes(
    earlier: DataFrame, later: DataFrame, m: tuple[int, ...] = SMALL_FILTER_SLOTS
) -> DataFrame:
    """Classes of two parts of the tags, given the classes of the first part
    and the tags ``(tag, pos)`` of the second."""
    known = earlier.select(F.col("first_tag").alias("tag"), "first_pos", F.col("n_first").alias("n"), "n_all")
    return _classes(known.unionByName(_tag_rows(later, "tag", "pos")), m)


def _classes(rows: DataFrame, m: tuple[int, ...]) -> DataFrame:
    """Sums per tag, then per class; both are cut down on the map side before
    anything moves, so neither a hot tag nor a hot class meets in one task."""
    tags = rows.groupBy("tag").agg(
        F.min("first_pos").alias("first_pos"), F.sum("n").alias("n"), F.sum("n_all").alias("n_all")
    )
    first = F.min_by(F.struct("tag", "n"), "first_pos").alias("first")
    classes = (
        bloom_bits(tags, "tag", m)
        .groupBy("bits")
        .agg(first, F.min("first_pos").alias("first_pos"), F.sum("n_all").alias("n_all"))
    )
    return classes.select(
        "bits", F.col("first.tag").alias("first_tag"), "first_pos", F.col("first.n").alias("n_first"), "n_all"
    )


def bloom_score(classes: DataFrame, m: tuple[int, ...] = SMALL_FILTER_SLOTS) -> DataFrame:
    """Stored tags, right and wrong "seen before" answers.

    A bit's first position is that of the first class using it: at most
    ``max(m)`` rows, which is what is broadcast.
    """
    first_bit = (
        classes.select(F.explode("bits").alias("bit"), "first_pos")
        .groupBy("bit")
        .agg(F.min("first_pos").alias("bit_pos"))
    )
    judged, early = classes, F.lit(True)
    for i in range(len(m)):
        side = first_bit.select(F.col("bit").alias(f"b{i}"), F.col("bit_pos").alias(f"p{i}"))
        judged = judged.withColumn(f"b{i}", F.col("bits")[i]).join(F.broadcast(side), f"b{i}")
        early = early & (F.col(f"p{i}") < F.col("first_pos"))
    rest = F.col("n_all") - F.col("n_first")
    none = F.lit(0).cast("bigint")
    return judged.agg(
        F.count_if(~early).alias("unique_tags"),
        F.coalesce(F.sum(F.when(~early, F.col("n_first") - 1)), none).alias("correct"),
        F.coalesce(F.sum(F.when(early, F.col("n_all")).otherwise(rest)), none).alias("incorrect"),
    )


def bloom_report(
    df: DataFrame, tag: str = "tag", pos: str = "pos", m: tuple[int, ...] = SMALL_FILTER_SLOTS
) -> DataFrame:
    """Score of the small filter over all appearances in order of ``pos``,
    which must be unique."""
    return bloom_score(slot_classes(df, tag, pos, m), m)


def _probes(n_bits: int) -> list:
    """Bit positions of a value, from two hashes."""
    first = text_hash(F.col("_key"))
    second = text_hash(F.concat(F.lit("+"), F.col("_key").cast("string")))
    return [F.pmod(first + i * second, F.lit(n_bits).cast("bigint")) for i in range(PROBES)]


def bloom_build(df: DataFrame, col: str, n_bits: int) -> DataFrame:
    """Filter over the values of ``col`` as ``(word, bits)``, 64 bits a row.
    OR-ed together on the map side, at most ``n_bits / 64`` rows."""
    at = df.select(F.col(col).alias("_key")).filter("_key IS NOT NULL").select(
        F.explode(F.array(*_probes(n_bits))).alias("at")
    )
    word = F.floor(F.col("at") / WORD_BITS).alias("word")
    bit = F.expr(f"shiftleft(1L, cast(at % {WORD_BITS} AS int))")
    return at.groupBy(word).agg(F.bit_or(bit).alias("bits"))


def bloom_filter(df: DataFrame, col: str, bits: DataFrame, n_bits: int) -> DataFrame:
    """Rows of ``df`` whose value may be in the filter.

    A filter within the broadcast limit is packed into one array, a scalar of
    the query, and all probes are tested in one projection. With a larger one
    the distinct values alone are joined by word, once, and the rows are then
    cut to the values found."""
    asked = df.withColumn("_key", F.col(col)).filter("_key IS NOT NULL")
    if n_bits <= BROADCAST_BITS:
        asked = asked.withColumn("_words", _packed(bits, n_bits).scalar()).withColumn("_spots", F.array(*_probes(n_bits)))
        return asked.filter(F.forall("_spots", lambda at: _is_set(F.get("_words", _word(at)), at))).select(*df.columns)
    spots = asked.select("_key").distinct().select("_key", F.explode(F.array(*_probes(n_bits))).alias("at"))
    hits = spots.join(bits, _word(F.col("at")) == bits["word"]).filter(_is_set(bits["bits"], F.col("at")))
    found = hits.groupBy("_key").agg(F.count("*").alias("n")).filter(F.col("n") == PROBES)
    return asked.join(found, "_key", "left_semi").select(*df.columns)


def _word(at: Column) -> Column:
    return F.floor(at / WORD_BITS).cast("int")


def _is_set(word: Column, at: Column) -> Column:
    bit = F.call_function("shiftright", word, (at % WORD_BITS).cast("int"))
    return F.coalesce(bit.bitwiseAND(F.lit(1).cast("long")) == 1, F.lit(False))


def _packed(bits: DataFrame, n_bits: int) -> DataFrame:
    """All words of a filter in order, as one array in one row; the broadcast
    limit bounds its length."""
    every = bits.sparkSession.range(-(-n_bits // WORD_BITS)).withColumnRenamed("id", "word")
    full = every.join(bits, "word", "left").select("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    return full.agg(F.array_sort(F.collect_list(F.struct("word", "bits")))["bits"].alias("words"))


def bloom_size(n: int, fpp: float) -> int:
    """Bits for ``n`` values at a false-positive share of about ``fpp``."""
    return max(WORD_BITS, math.ceil(-n * math.log(fpp) / math.log(2) ** 2))
