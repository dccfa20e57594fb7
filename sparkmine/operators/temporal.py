"""Joins on time: the latest earlier row, and overlapping intervals.

Neither needs a nested loop, and neither brings a whole key into one task: time is
cut into slices (or bins), and a key's rows meet slice by slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICES = 64  # time ranges with about equally many rows
ACCURACY = 10_000


def _bounds(times: DataFrame, slices: int) -> list[int]:
    """Microseconds that cut the rows into ``slices`` ranges of about equal size;
    a mergeable quantile sketch over all rows, at most ``slices`` numbers."""
    shares = [i / slices for i in range(1, slices)]
    found = times.agg(F.percentile_approx(F.unix_micros("at"), shares, ACCURACY).alias("cuts")).first()["cuts"] if shares else None
    return sorted(set(found or ()))


def _slice(at: Column, cuts: list[int]) -> Column:
    if not cuts:
        return F.lit(0)
    return F.coalesce(F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.unix_micros(at))), F.lit(0))


def _latest(order: Window, unlike: str | None) -> tuple[Column, Column]:
    """Before each row: the latest right row, and the latest one that differs from
    that one in ``unlike``. The second is set where a run of equal ones begins."""
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    latest = F.last("theirs", ignorenulls=True).over(before)
    if unlike is None:
        return latest, F.lit(None)
    begins = F.col("theirs").isNotNull() & ~F.col("latest")[unlike].eqNullSafe(F.col("theirs")[unlike])
    return latest, F.last(F.when(begins, F.col("latest")), ignorenulls=True).over(before)


def _marked(rows: DataFrame, order: Window, unlike: str | None) -> DataFrame:
    latest, other = _latest(order, unlike)
    rows = rows.withColumn("latest", latest)
    return rows.withColumn("other", other if unlike else F.lit(None).cast(rows.schema["latest"].dataType))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    on: str,
    strict: bool = True,
    ties: Sequence[str] = (),
    unlike: str | None = None,
    match: str = "match",
    slices: int = SLICES,
) -> DataFrame:
    """Each left row with the latest right row of its key that is earlier (not
    ``strict``: no later), as a struct ``match`` of the right row's columns; null
    where there is none. Both sides have the columns ``by`` and ``on`` (a time).

    Of right rows at one time the last by ``ties`` counts. With ``unlike``, only
    right rows count that differ from the left row in that column.

    Both sides become one table, sorted by time within key and time slice, and the
    last right row is carried on within the slice. Every slice leaves at most two
    rows, the last and the last that differs from it; these are carried over
    the slices of a key and joined to the rows. A key with a third of all rows is
    spread over ``slices`` tasks.

    Left rows with a null key or time match nothing and stay; right ones are left
    out. Repeated rows stay repeated; empty sides are allowed."""
    usable = F.lit(True)
    for c in (*by, on):
        usable = usable & F.col(c).isNotNull()
    right = right.filter(usable)
    keys = [f"key{i}" for i in range(len(by))]

    def side(df: DataFrame, right_side: bool) -> DataFrame:
        row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
        tie = F.struct(F.lit(0), *[F.col(c) for c in ties]) if right_side else F.lit(None)
        return df.select(
            *[F.col(c).alias(k) for c, k in zip(by, keys)],
            F.col(on).cast("timestamp").alias("at"),
            F.lit(int(right_side == strict)).alias("turn"),
            tie.alias("tie"),
            (F.lit(None) if right_side else row).alias("ours"),
            (row if right_side else F.lit(None)).alias("theirs"),
        )

    both = side(left, False).unionByName(side(right, True))
    cuts = _bounds(both.select("at"), slices)
    both = both.withColumn("slice", _slice(F.col("at"), cuts))
    order = [F.asc_nulls_first("at"), "turn", "tie"]
    rows = _marked(both, Window.partitionBy(*keys, "slice").orderBy(*order), unlike)
    if cuts:
        # What a slice hands on: its last right row and the last that differs from it.
        when = F.when(F.col("theirs").isNotNull(), F.struct("at", "tie"))
        end = F.max_by("theirs", when).alias("end")
        if unlike:
            # Seen from the last right row: what went before it, if that differs, or
            # else what differs from that.
            differs = ~F.col("latest")[unlike].eqNullSafe(F.col("theirs")[unlike])
            known = rows.groupBy(*keys, "slice").agg(end, F.max_by(F.when(differs, F.col("latest")).otherwise(F.col("other")), when).alias("before"))
        else:
            known = both.groupBy(*keys, "slice").agg(end).withColumn("before", F.lit(None).cast(both.schema["theirs"].dataType))
        handed = known.select(*keys, "slice", F.posexplode(F.array("before", "end")).alias("turn", "theirs"))
        per_key = Window.partitionBy(*keys).orderBy("slice", "turn")  # two rows a slice
        carried = _marked(handed, per_key, unlike).filter("turn = 0").select(*keys, "slice", F.col("latest").alias("carried"), F.col("other").alias("carried_other"))
        slots = [F.col(k).alias(f"c_{k}") for k in keys]
        carried = carried.select(*slots, F.col("slice").alias("c_slice"), "carried", "carried_other").filter("carried IS NOT NULL")
        same = F.col("slice") == F.col("c_slice")
        for k in keys:
            same = same & (F.col(k) == F.col(f"c_{k}"))
        rows = rows.filter("ours IS NOT NULL").join(carried, same, "left")
        choices = ("latest", "other", "carried", "carried_other")
    else:
        rows = rows.filter("ours IS NOT NULL")
        choices = ("latest", "other")
    if unlike is None:
        found = F.coalesce(*[F.col(c) for c in choices if not c.endswith("other")])
    else:
        found = F.coalesce(*[F.when(~F.col(c)[unlike].eqNullSafe(F.col("ours")[unlike]), F.col(c)) for c in choices])
    return rows.select("ours.*", found.alias(match))


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    width: int,
    by: Sequence[str] = (),
) -> DataFrame:
    """Pairs of rows, as structs ``ours`` and ``theirs``, whose half-open time spans
    overlap and whose columns ``by`` are equal.

    Time is cut into bins of ``width`` seconds. A span is listed in each bin it
    touches, ``length / width + 1`` times, so choose a width about as long as most
    spans. Rows are joined by key and bin, and a pair counts in the first bin that
    both touch, so it comes out once. A hot key is spread over its bins.

    Spans with a null end, and empty or reversed ones, overlap nothing."""

    def binned(df: DataFrame, span: tuple[str, str], name: str) -> DataFrame:
        start, end = (F.unix_micros(F.col(c).cast("timestamp")) for c in span)
        first, last = F.floor(start / (width * 1_000_000)), F.floor((end - 1) / (width * 1_000_000))
        keys = [F.col(c).alias(f"{name}_key{i}") for i, c in enumerate(by)]
        rows = df.filter(start < end).select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name), *keys, start.alias(f"{name}_start"), end.alias(f"{name}_end"), first.alias(f"{name}_first"), last.alias("last"))
        return rows.select("*", F.explode(F.sequence(f"{name}_first", "last")).alias(f"{name}_bin")).drop("last")

    a, b = binned(left, left_span, "ours"), binned(right, right_span, "theirs")
    same = a["ours_bin"] == b["theirs_bin"]
    for i in range(len(by)):
        same = same & (a[f"ours_key{i}"] == b[f"theirs_key{i}"])
    once = F.col("ours_bin") == F.greatest("ours_first", "theirs_first")
    overlap = (F.col("ours_start") < F.col("theirs_end")) & (F.col("theirs_start") < F.col("ours_end"))
    return a.join(b, same & once & overlap).select("ours", "theirs")
