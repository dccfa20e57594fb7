"""Text and post expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_commas(c: str | Column) -> Column:
    return F.replace(_col(c), F.lit(","))


def has_words(c: str | Column) -> Column:
    """False for a line of blanks only; it splits into no word at all."""
    text = _col(c)
    return (F.rtrim(text) != "") | (text == "")


def tokens(c: str | Column) -> Column:
    """Split on single blanks; trailing empty words go, inner ones stay.

    An empty line is one empty word, a line of blanks only has no word. Only
    blanks are cut off the end, not tabs or line ends.
    """
    text = _col(c)
    words = F.split(F.rtrim(text), " ", -1)
    return F.when(has_words(text), words).when(text.isNotNull(), F.array().cast("array<string>"))


def hashtags(c: str | Column) -> Column:
    """Words behind a ``#``, in order of appearance, repeats kept: letters,
    marks and digits of any script, and ``_``."""
    return F.regexp_extract_all(_col(c), F.lit(r"#([\p{L}\p{M}\p{N}_]+)"), 1)


def tracked(c: str | Column, word: str) -> Column:
    return F.contains(F.lower(_col(c)), F.lit(word.lower()))
