"""Quality rules with thresholds learned per language and source.

Built-in expressions only. Everything about one text is computed inside its
row; no word ever becomes a row.

Four ratios of a text are judged against its peers: symbols and repeated words
per word, repeated lines per line, characters per word. Each ratio of each
group is summed up in a quantile sketch: counts over buckets whose bounds grow
by ``GROWTH``, so a quantile read off the sketch is within that factor of the
true one, sketches of parts add up to the sketch of the whole in any order,
and a group's sketch has at most ``BUCKETS`` rows. Source sketches add up to
language sketches, which judge the sources with fewer than ``FEWEST``
documents and those whose source is null.

A document is out if a ratio lies beyond the group's fence, the nine-tenths quantile
plus ``REACH`` times its distance from the median and a margin of ``MARGIN`` (for
characters per word also below the fence on the other side). The fences decide: a
ratio that nearly all peers have at zero has a fence at ``LEAST_HELD``, a few
hundredths, and ``FREE`` of its units count for nothing, so that a head or passage
that comes twice is not held against a short text.
Documents that fail the fixed base rules teach nothing and are not kept.

Defined results: null text has no words and fails; null language or source is
a group like any other; rows with equal ids are separate rows; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.plans.workspace import materialize

WINDOW = 8
GROWTH = 1.05
BUCKETS = 400  # bounds from 1e-4 to about 3e4
LEAST = 1e-4
REACH = 3.0
MARGIN = 0.1  # of the outer quantile
OUTER = 0.9
FEWEST = 200

# The judged ratios. Where a group's fence is lower than this, it is this.
LEAST_HELD = {"symbol_ratio": 0.03, "repeat_ratio": 0.05, "dup_line_ratio": 0.10, "mean_chars": 0.0}
FREE = {"repeat_ratio": 40, "dup_line_ratio": 2}  # words, lines

# Fixed values of the base rules and of the characters they count.
BLANKS = r"[ \t\n\x0B\f\r]"
NOT_SYMBOLS = r"[^#*$%&|<>]+"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANKS + "+"), "")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]"))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def repeated_words(ws: Column) -> Column:
    """Words inside an 8-word window that the text has twice or more."""

    def of_hashes(hs: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hs) - WINDOW)
        windows = F.transform(starts, lambda i: F.xxhash64(*[hs[i + j] for j in range(WINDOW)]))
        return let(windows, of_windows)

    def of_windows(win: Column) -> Column:
        # Most texts repeat no window; only the others are sorted.
        return F.when(F.size(F.array_distinct(win)) == F.size(win), F.lit(0).cast("long")).otherwise(
            let(F.array_sort(F.transform(win, lambda x, i: F.struct(x.alias("h"), i.alias("at")))), of_sorted)
        )

    def of_sorted(s: Column) -> Column:
        twin = F.transform(
            s,
            lambda x, i: F.when(
                F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)), x["at"]
            ),
        )
        return let(F.array_sort(F.filter(twin, lambda x: x.isNotNull())), covered)

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    hashes = F.transform(ws, lambda w: F.xxhash64(w))
    return F.when(F.size(ws) <= WINDOW, F.lit(0).cast("long")).otherwise(let(hashes, of_hashes))


def stats(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns ``STATS`` and ``n_lines`` in a struct ``q``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    counted = let(
        words(text),
        lambda ws: F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(text, NOT_SYMBOLS, "")).cast("long").alias("n_symbols"),
            duplicate_lines(text).alias("n_dup_lines"),
            repeated_words(ws).alias("n_repeat_words"),
            F.size(F.split(text, "\n")).cast("long").alias("n_lines"),
        ),
    )
    return docs.withColumn("q", counted)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def bucket(value: Column) -> Column:
    """Number of the sketch bucket that holds a value; bucket 0 holds all up to
    ``LEAST``, the last one all above the highest bound."""
    at = F.ceil(F.log(value / LEAST) / math.log(GROWTH)).cast("int")
    return F.when(value <= LEAST, F.lit(0)).otherwise(F.least(at, F.lit(BUCKETS)))


def _quantile(cum: str, total: str, q: float) -> Column:
    """Upper bound of the first bucket at which the running count reaches ``q``."""
    at = F.min(F.when(F.col(cum) >= F.col(total) * q, F.col("bucket")))
    return F.when(at == 0, F.lit(0.0)).otherwise(LEAST * F.pow(F.lit(GROWTH), at))


def fences(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Fences and size per group and ratio from ``keys, ratio, bucket, n``."""
    group = Window.partitionBy(*keys, "ratio")  # at most BUCKETS rows
    running = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    summed = sketches.withColumn("cum", F.sum("n").over(running)).withColumn("total", F.sum("n").over(group))
    quantiles = [_quantile("cum", "total", q).alias(name) for name, q in (("low", 1 - OUTER), ("mid", 0.5), ("high", OUTER))]
    found = summed.groupBy(*keys, "ratio").agg(*quantiles, F.max("total").alias("size"))
    wide = found.withColumn("hi", (1 + MARGIN) * F.col("high") + REACH * (F.col("high") - F.col("mid")))
    wide = wide.withColumn("lo", (1 - MARGIN) * F.col("low") - REACH * (F.col("mid") - F.col("low")))
    aggs = [F.max(F.when(F.col("ratio") == r, F.greatest(F.col("hi"), F.lit(least)))).alias(f"{r}_hi") for r, least in LEAST_HELD.items()]
    return wide.groupBy(*keys).agg(*aggs, F.max(F.when(F.col("ratio") == "mean_chars", F.col("lo"))).alias("mean_chars_lo"), F.max("size").alias("size"))


def judge(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``STATS``, ``base_failed`` and ``kept`` of every document."""
    doc = stats(docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source")))
    doc = doc.select("doc_id", "lang", "source", "q.*")
    n = F.greatest(F.col("n_words"), F.lit(1))
    doc = doc.select(
        "doc_id",
        "lang",
        "source",
        *STATS,
        base_failed(F.col("n_words"), F.col("n_repeat_words")).alias("base_failed"),
        (F.col("n_symbols") / n).alias("symbol_ratio"),
        (F.greatest(F.col("n_repeat_words") - FREE["repeat_ratio"], F.lit(0)) / n).alias("repeat_ratio"),
        (F.greatest(F.col("n_dup_lines") - FREE["dup_line_ratio"], F.lit(0)) / F.col("n_lines")).alias("dup_line_ratio"),
        (F.col("word_chars") / n).alias("mean_chars"),
    )
    doc = materialize(doc, "quality")  # a row of numbers per document
    values = F.explode(F.array(*[F.struct(F.lit(r).alias("ratio"), bucket(F.col(r)).alias("bucket")) for r in LEAST_HELD]))
    sketches = doc.filter(~F.col("base_failed")).select("lang", "source", values.alias("v")).groupBy("lang", "source", "v.ratio", "v.bucket").agg(F.count("*").alias("n"))
    own = fences(sketches, ["lang", "source"]).filter((F.col("size") >= FEWEST) & F.col("source").isNotNull())
    shared = fences(sketches.groupBy("lang", "ratio", "bucket").agg(F.sum("n").alias("n")), ["lang"])
    own = own.select(F.col("lang").alias("ol"), F.col("source").alias("os"), F.struct(*[c for c in own.columns if c.startswith(tuple(LEAST_HELD))]).alias("own"))
    shared = shared.select(F.col("lang").alias("sl"), F.struct(*[c for c in shared.columns if c.startswith(tuple(LEAST_HELD))]).alias("shared"))
    joined = doc.join(own, F.col("lang").eqNullSafe(F.col("ol")) & (F.col("source") == F.col("os")), "left").join(shared, F.col("lang").eqNullSafe(F.col("sl")), "left")
    fence = F.coalesce("own", "shared")
    out = [F.col(r) > fence[f"{r}_hi"] for r in LEAST_HELD]
    out.append(F.col("mean_chars") < fence["mean_chars_lo"])
    beyond = reduce(lambda a, b: a | b, [F.coalesce(o, F.lit(False)) for o in out])
    return joined.select("doc_id", *STATS, "base_failed", (~F.col("base_failed") & ~beyond).alias("kept"))
