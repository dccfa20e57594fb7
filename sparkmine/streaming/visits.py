"""Visits of users with running totals, kept as state that timers end.

A visit is a stretch of a user's events without a pause of ``gap``. It is written once,
when the watermark has passed its end, with its number and the totals of the user so
far; a pause of ``forget`` starts the count anew and frees the state. State and timers
lie in Spark's state store, so a stream that is started again goes on where it was.

The events of a user meet in one task, so they are first joined to spans where they are
read, a batch at a time: a busy user sends a few spans, not every event. Open visits of
a user number at most the time under the watermark over ``gap``. They lie in one value
of the state with one timer, so a batch reads, writes and wakes a user a fixed number of
times however many visits there are.

Events without a user or a time are left out, an event without an amount adds zero.
Spans that end before the watermark are dropped as late.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from sparkmine.streaming.windows import run_append

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SPANS = "user BIGINT, first BIGINT, last BIGINT, n BIGINT, total BIGINT, at TIMESTAMP"
VISITS = "user BIGINT, visit BIGINT, first_us BIGINT, last_us BIGINT, n BIGINT, total BIGINT, n_so_far BIGINT, total_so_far BIGINT"
KEPT = "first ARRAY<BIGINT>, last ARRAY<BIGINT>, n ARRAY<BIGINT>, total ARRAY<BIGINT>, visits BIGINT, n_past BIGINT, total_past BIGINT, last_past BIGINT, timer BIGINT"
HOUR = 3_600_000_000  # microseconds

Span = tuple[int, int, int, int]  # first, last, n, total


def _spans(batches: Iterator[pa.RecordBatch], gap: int) -> Iterator[pa.RecordBatch]:
    """Events (user, us, amount) of a batch, joined to spans."""
    for batch in batches:
        user, us, amount = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if not len(user):
            continue
        order = np.lexsort((us, user))
        user, us, amount = user[order], us[order], amount[order]
        begins = np.flatnonzero(np.concatenate(([True], (user[1:] != user[:-1]) | (us[1:] - us[:-1] >= gap))))
        ends = np.append(begins[1:], len(user))
        last = us[ends - 1]
        columns = [user[begins], us[begins], last, ends - begins, np.add.reduceat(amount, begins)]
        arrays = [pa.array(c, pa.int64()) for c in columns] + [pa.array(last, pa.timestamp("us", "UTC"))]
        yield pa.RecordBatch.from_arrays(arrays, ["user", "first", "last", "n", "total", "at"])


def add_span(spans: list[Span], new: Span, gap: int) -> None:
    """Join ``new`` with all spans less than ``gap`` from it; ``spans`` stay sorted and apart."""
    at = bisect_left(spans, new)
    low = at
    while low and new[0] - spans[low - 1][1] < gap:
        low -= 1
    high = at
    while high < len(spans) and spans[high][0] - new[1] < gap:
        high += 1
    joined = [*spans[low:high], new]
    spans[low:high] = [(min(s[0] for s in joined), max(s[1] for s in joined), sum(s[2] for s in joined), sum(s[3] for s in joined))]


def _ms(us: int) -> int:
    return -(-us // 1000)


class Visits(StatefulProcessor):
    def __init__(self, gap: int, forget: int):
        self.gap, self.forget = gap, forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", KEPT)

    def _kept(self) -> tuple[list[Span], tuple]:
        """Open visits in order, and what is known of the closed ones."""
        held = self.kept.get()
        if held is None:
            return [], (0, 0, 0, None, None)
        return list(zip(*held[:4], strict=True)), tuple(held[4:])

    def _keep(self, spans: list[Span], visits: int, n: int, total: int, last: int | None, timer: int | None) -> None:
        columns = [list(c) for c in zip(*spans, strict=True)] or [[], [], [], []]
        self.kept.update((*columns, visits, n, total, last, timer))

    def _wake(self, at: int, timer: int | None) -> int:
        """One timer at a time, unless an earlier one is needed; a later one that is left finds nothing due."""
        if timer is None or at < timer:
            self.handle.registerTimer(at)
            return at
        return timer

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        spans, (visits, n, total, last, timer) = self._kept()
        for r in rows:
            add_span(spans, (r["first"], r["last"], r["n"], r["total"]), self.gap)
        timer = self._wake(_ms(min(s[1] for s in spans) + self.gap), timer)
        self._keep(spans, visits, n, total, last, timer)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs()
        spans, (visits, n, total, last, timer) = self._kept()
        if timer is None or timer > mark:  # what was due is done
            return iter(())
        closed, still = [], []
        for span in spans:
            first, end, rows, amount = span
            if _ms(end + self.gap) > mark:
                still.append(span)
                continue
            if last is None or first - last >= self.forget:
                visits, n, total = 0, 0, 0
            visits, n, total, last = visits + 1, n + rows, total + amount, end
            closed.append(Row(user=key[0], visit=visits, first_us=first, last_us=end, n=rows, total=amount, n_so_far=n, total_so_far=total))
        if still:
            self._keep(still, visits, n, total, last, self._wake(_ms(min(s[1] for s in still) + self.gap), None))
        elif last is not None and _ms(last + self.forget) > mark:
            self._keep([], visits, n, total, last, self._wake(_ms(last + self.forget), None))
        else:
            self.kept.clear()
        return iter(closed)

    def close(self) -> None:
        pass


def visits(events: DataFrame, user: str, at: str, amount: str, delay: str, gap: int = 6 * HOUR, forget: int = 72 * HOUR) -> DataFrame:
    """The closed visits of a stream of ``events``. ``user`` and ``amount`` are whole
    numbers, ``gap`` and ``forget`` (not less than ``gap``) microseconds."""
    if not 0 < gap <= forget:
        raise ValueError("forget must not be shorter than gap")
    known = events.filter(F.col(user).isNotNull() & F.col(at).isNotNull())
    known = known.select(F.col(user).cast("bigint"), F.unix_micros(at), F.coalesce(F.col(amount).cast("bigint"), F.lit(0)))
    spans = known.mapInArrow(lambda batches: _spans(batches, gap), SPANS).withWatermark("at", delay)
    return spans.groupBy("user").transformWithState(Visits(gap, forget), VISITS, "Append", "EventTime")


def run_visits(rows: DataFrame, path: str, available_now: bool = False) -> StreamingQuery:
    """Append closed visits to the table that ``windows.read_out`` reads. Timers need
    Spark's RocksDB state store; it is set for this query alone."""
    conf = rows.sparkSession.conf
    before = conf.get(STORE)
    conf.set(STORE, ROCKS)
    try:
        return run_append(rows, path, available_now)
    finally:
        conf.set(STORE, before)
