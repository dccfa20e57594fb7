"""Engine-neutral hashes: the same numbers come out of any SQL engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Slots addressed by the two bit functions of the small filter.
SMALL_FILTER_SLOTS = (10, 30)


def text_hash(c: Column) -> Column:
    """Non-negative 32-bit number from the first eight hex digits of md5."""
    return F.conv(F.substring(F.md5(c.cast("string")), 1, 8), 16, 10).cast("bigint")


def slot(c: Column, n_slots: int) -> Column:
    return F.pmod(text_hash(c), F.lit(n_slots).cast("bigint"))


def priority(seed: int, *ids: str) -> Column:
    """Seeded random-looking order key of a row; md5 over seed and ids."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(i).cast("string") for i in ids]))
