"""Periodic runs of words, found by longest common extensions.

A run is a stretch of consecutive words with smallest period ``q`` that is at
least ``max(MIN_LENGTH, 2 q)`` words long and that no neighbouring word extends.

1. *Harmonic grid.* The places ``i`` of a run where word ``i`` equals word ``i + q``
   are ``max(q, MIN_LENGTH - q)`` consecutive ones at least, so every run holds a
   place that is a multiple of that number. For each period only those places are
   asked, about ``n ln n`` for ``n`` words: how far do ``i`` and ``i + q`` agree to
   the right, how far to the left. A run is taken at its first such place. Multiples
   of its period give the same stretch again; the smallest period stays.
2. *Few words first.* Both sides are compared word by word until they differ or
   reach places that are both in the difference cover: among the residues ``COVER``
   modulo ``V`` = 13 every difference occurs, so this takes 12 words at most. Nearly
   all questions end here.
3. *Sampled suffixes.* Only texts with questions that reached such places get more:
   their suffixes at cover places are sorted (their first 13 words, then ranks 13,
   26, 52 ... words on, until all differ), neighbours' common lengths follow from the
   ranks of all steps, and a sparse table of minima answers each question in one
   look. The same over the reversed words serves the other side.

Words become numbers through a dictionary, so equality is exact. Texts are taken
together up to ``PAIRS`` questions; a longer one is asked in slices of that size.
Every text is judged where it is read: there is no exchange at all.

Defined results: null text has no words and no runs; rows are judged one by one,
whatever their ids; an empty table gives an empty result; columns other than
``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 12
V = 13
COVER = (0, 1, 3, 9)
PAIRS = 1 << 20

FOUND = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
_FOUND_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
BLANKS = r"[ \t\n\x0B\f\r]+"


def _sync() -> np.ndarray:
    """Steps until residues ``a`` and ``a + d`` are both in the cover, at ``[a, d]``."""
    held = np.isin(np.arange(3 * V) % V, COVER)
    return np.array([[next(t for t in range(V) if held[a + t] and held[(a + d) % V + t]) for d in range(V)] for a in range(V)])


SYNC = _sync()


class Extensions:
    """Common extensions to the right of places of ``ids``, in which every text is
    followed by a number that occurs once."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.table = ids, None

    def near(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words that agree before a difference or a place where both are in the
        cover, and which of the pairs are still open there."""
        agreed, synced = np.zeros(len(i), np.int64), np.zeros(len(i), bool)
        steps = SYNC[i % V, (j - i) % V]
        live = np.arange(len(i))
        for t in range(V):
            here = steps[live] == t
            synced[live[here]] = True
            live = live[~here]
            live = live[self.ids[i[live] + t] == self.ids[j[live] + t]]
            if not len(live):
                break
            agreed[live] += 1
        return agreed, synced

    def length(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        agreed, synced = self.near(i, j)
        at = np.flatnonzero(synced)
        if len(at):
            if self.table is None:
                self._sort()
            agreed[at] += self._of_samples(i[at] + agreed[at], j[at] + agreed[at])
        return agreed

    def _of_samples(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        a, b = self.rank[self.number[x]], self.rank[self.number[y]]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        return np.minimum(self.table[self.level[level] + lo], self.table[self.level[level] + hi - (1 << level)])

    def _sort(self) -> None:
        n = len(self.ids)
        places = np.flatnonzero(np.isin(np.arange(n) % V, COVER))
        self.number = np.full(n, -1)
        self.number[places] = np.arange(len(places))
        padded = np.concatenate([self.ids, np.zeros(V, np.int64)])
        width = int(self.ids.max()).bit_length()
        keys = []
        for first in range(0, V, 62 // width):
            key = np.zeros(len(places), np.int64)
            for t in range(first, min(V, first + 62 // width)):
                key = (key << width) | padded[places + t]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(places), bool)
        for key in keys:
            new[1:] |= key[order][1:] != key[order][:-1]
        rank = np.empty(len(places), np.int64)
        rank[order] = np.cumsum(new)
        ranks, step = [rank], V
        while int(rank.max()) + 1 < len(places):
            later = places + step
            following = np.zeros(len(places), np.int64)
            inside = np.flatnonzero(later < n)
            following[inside] = rank[self.number[later[inside]]] + 1
            _, rank = np.unique(rank * (len(places) + 1) + following, return_inverse=True)
            ranks.append(rank)
            step *= 2
        self.rank = rank
        order = np.argsort(rank)
        a, b = places[order[:-1]], places[order[1:]]
        lowest = np.zeros(len(a), np.int64)
        for level in range(len(ranks) - 2, -1, -1):
            inside = np.flatnonzero(b + lowest < n)
            inside = inside[a[inside] + lowest[inside] < n]
            same = inside[ranks[level][self.number[a[inside] + lowest[inside]]] == ranks[level][self.number[b[inside] + lowest[inside]]]]
            lowest[same] += V << level
        live = np.arange(len(a))
        for _ in range(V):
            live = live[padded[a[live] + lowest[live]] == padded[b[live] + lowest[live]]]
            lowest[live] += 1
        # Row k of the sparse table: minima of 2^k neighbours. All rows in one array.
        rows, half = [lowest], 1
        while 2 * half <= len(lowest):
            rows.append(np.minimum(rows[-1][:-half], rows[-1][half:]))
            half *= 2
        self.level = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        self.table = np.concatenate(rows)


class Texts:
    """Texts laid one after another, a number that occurs once before the first and
    after each; ``starts`` and ``sizes`` in words."""

    def __init__(self, parts: list[np.ndarray], distinct: int):
        ends = distinct + np.arange(len(parts) + 1)
        laid = [ends[:1]]
        for part, end in zip(parts, ends[1:]):
            laid += [part, end[None]]
        self.parts, self.distinct = parts, distinct
        self.sizes = np.array([len(p) for p in parts], np.int64)
        self.starts = 1 + np.cumsum(self.sizes + 1) - (self.sizes + 1)
        self.ids = np.concatenate(laid)
        self.right, self.left = Extensions(self.ids), Extensions(self.ids[::-1].copy())

    def open(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words that agree from ``i`` and ``j`` on, those that agree before them, and
        whether one of the sides is still open."""
        n = len(self.ids)
        right, more = self.right.near(i, j)
        left, more_left = self.left.near(n - i, n - j)
        return right, left, more | more_left

    def whole(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.ids)
        return self.right.length(i, j), self.left.length(n - i, n - j)


def _grid(size: int | np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distance and number of the places to ask."""
    step = np.maximum(period, MIN_LENGTH - period)
    return step, (size - period - 1) // step + 1


def _asked(texts: Texts) -> Iterator[tuple[np.ndarray, ...]]:
    """``(text, place, period, step)`` of the questions, in slices of whole periods."""
    half = np.where(texts.sizes >= MIN_LENGTH, texts.sizes // 2, 0)
    text = np.repeat(np.arange(len(half)), half)
    period = np.arange(len(text)) - np.repeat(np.cumsum(half) - half, half) + 1
    step, n = _grid(texts.sizes[text], period)
    total = np.cumsum(n)
    first = 0
    while first < len(n):
        last = max(first + 1, int(np.searchsorted(total, total[first] - n[first] + PAIRS, "right")))
        some = slice(first, last)
        row = np.repeat(np.arange(first, last), n[some])
        k = np.arange(len(row)) - np.repeat(np.cumsum(n[some]) - n[some], n[some])
        yield text[row], texts.starts[text[row]] + k * step[row], period[row], step[row]
        first = last


def maximal_runs(texts: Texts) -> np.ndarray:
    """``text, start, length, period`` of all runs, one per row, by text, start and
    period; starts are numbered from 0 within a text."""
    found, hard = [], None
    for text, i, p, step in _asked(texts):
        same = np.flatnonzero(texts.ids[i] == texts.ids[i + p])
        text, i, p, step = text[same], i[same], p[same], step[same]
        right, left, more = texts.open(i, i + p)
        at = np.flatnonzero(more)
        if len(at):
            # The texts of these questions alone, in a layout of their own.
            own = np.unique(text[at])
            if hard is None or len(texts.parts) > 1:
                hard = Texts([texts.parts[t] for t in own], texts.distinct)
            asked = i[at] - texts.starts[text[at]] + hard.starts[np.searchsorted(own, text[at])]
            right[at], left[at] = hard.whole(asked, asked + p[at])
        run = np.flatnonzero((right + left >= step) & (left < step))
        found.append(np.stack([text[run], (i - left)[run] - texts.starts[text[run]], (right + left + p)[run], p[run]], axis=1))
    rows = np.concatenate(found) if found else np.empty((0, 4), np.int64)
    # One stretch with several periods has the smallest of them.
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    rows = rows[first]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _groups(words: list[list[bytes]]) -> Iterator[tuple[int, int]]:
    """First and last of texts that are asked together."""
    first, asked = 0, 0
    for at, ws in enumerate(words):
        size = len(ws) * max(1, len(ws)).bit_length()
        if at > first and asked + size > PAIRS:
            yield first, at
            first, asked = at, 0
        asked += size
    if first < len(words):
        yield first, len(words)


def _judge(words: list[list[bytes]]) -> Iterator[tuple[list[tuple[int, int, int]], bytes]]:
    for first, last in _groups(words):
        number: dict[bytes, int] = defaultdict(count().__next__)
        parts = [np.fromiter(map(number.__getitem__, ws), np.int64, len(ws)) for ws in words[first:last]]
        rows = maximal_runs(Texts(parts, len(number)))
        bounds = np.searchsorted(rows[:, 0], np.arange(last - first + 1))
        for k, ws in enumerate(words[first:last]):
            runs = rows[bounds[k] : bounds[k + 1], 1:]
            if len(runs):
                depth = np.zeros(len(ws) + 1, np.int64)
                np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
                np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
                ws = compress(ws, (np.cumsum(depth[:-1]) == 0).tolist())
            yield runs.tolist(), b" ".join(ws)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [(t or b"").split() for t in batch.column("text").cast(pa.binary()).to_pylist()]
        runs, collapsed = [], []
        for found, text in _judge(words):
            runs.append([{"start": s, "length": n, "period": p} for s, n, p in found])
            collapsed.append(text)
        yield pa.record_batch({
            "doc_id": batch.column("doc_id"),
            "n_words": pa.array([len(ws) for ws in words], pa.int64()),
            "runs": pa.array(runs, _FOUND_RUNS),
            "collapsed": pa.array(collapsed, pa.binary()).cast(pa.string()),
        })


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every document: its runs by start and
    period, and its words, joined by one blank, without those that a run holds
    behind its first period."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_rows, FOUND)


def plant(doc_id: Column, text: Column) -> Column:
    """The text with a periodic tail in about one document of ten, chosen by the
    checksum of its id: from word ``g % n`` on, words repeat with a period of up to
    a third of the rest. Other texts, also those without id, stay as they are."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def planted(ws: Column) -> Column:
        n = F.size(ws)
        return F.when(n == 0, text).otherwise(F.transform(F.array(g % n), lambda a: F.array_join(tail(ws, n, a), " "))[0])

    def tail(ws: Column, n: Column, a: Column) -> Column:
        period = F.lit(1) + F.floor((n - a) / (3 + g % 8))
        return F.transform(ws, lambda w, i: F.when(i < a, w).otherwise(F.get(ws, (a + (i - a) % period).cast("int"))))

    words = F.array_remove(F.split(text, BLANKS), "")
    return F.when(h % 10 == 0, F.transform(F.array(words), planted)[0]).otherwise(text)


def digests(found: DataFrame) -> DataFrame:
    """Per document the number of runs, the longest (ties: smallest start, then
    period), and digests of all runs and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    found = found.select("*", best.alias("best"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
