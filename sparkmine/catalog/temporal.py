"""Joins on time and event-time windows over the event, order and line tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.catalog.stream import EVENTS_SCHEMA, PARTS
from sparkmine.operators import temporal
from sparkmine.plans.workspace import new_path
from sparkmine.sources import fixtures as fx
from sparkmine.sources import readers
from sparkmine.streaming import visits, windows

WINDOW_DAYS = 7
DELAY = "2 days"
LATE = 41  # every so manieth event arrives two parts late


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")


def join_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with the user's latest earlier event of another kind."""
    events = _events(spark, sf_dir)
    found = temporal.asof_join(events, events, ["user_id"], "ts", ties=["event_id"], unlike="event_type")
    return found.select("event_id", F.col("match.event_id").alias("prev_id"), F.col("match.event_type").alias("prev_type"))


def join_asof_click(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with the user's latest click up to then."""
    events = _events(spark, sf_dir)
    purchases, clicks = events.filter("event_type = 'purchase'"), events.filter("event_type = 'click'")
    found = temporal.asof_join(purchases, clicks.select("user_id", "ts", "event_id"), ["user_id"], "ts", strict=False, ties=["event_id"])
    return found.select("event_id", F.col("match.event_id").alias("click_id"), F.unix_micros(F.col("ts")).alias("at_us"), F.unix_micros("match.ts").alias("click_us"))


def join_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines on their way (as many days as they have pieces) while another order of
    the customer is a week old or less."""
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_quantity")
    days = lambda n: F.make_dt_interval(n.cast("int"))
    spans = lines.join(orders.select("o_orderkey", F.col("o_custkey").alias("cust")), F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    spans = spans.withColumn("received", F.col("l_shipdate") + days(F.col("l_quantity")))
    fresh = orders.withColumnRenamed("o_custkey", "cust").withColumn("until", F.col("o_orderdate") + days(F.lit(WINDOW_DAYS)))
    found = temporal.overlap_join(spans, fresh, ("l_shipdate", "received"), ("o_orderdate", "until"), 30 * 86400, ["cust"])
    return found.filter("ours.l_orderkey <> theirs.o_orderkey").select("ours.l_orderkey", "ours.l_linenumber", "ours.l_suppkey", "theirs.o_orderkey")



def _arriving(spark: SparkSession, sf_dir: str, start: Callable[[Callable[[], DataFrame]], None], late: bool = False) -> None:
    """Events arrive in ``PARTS`` parts by id, with ``late`` some of them two parts
    later; the stream is started again for each part."""
    events = fx.table(spark, sf_dir, "events")
    top = events.agg(F.max("event_id")).first()[0] or 0
    part = F.floor(F.col("event_id") * PARTS / F.lit(top + 1)).cast("int")
    if late:
        part = F.when(F.col("event_id") % LATE == 0, F.least(part + 2, F.lit(PARTS - 1))).otherwise(part)
    folder = new_path(spark, "events")
    for i in range(PARTS):
        events.filter(part == i).write.mode("append").parquet(folder)
        start(lambda: readers.read_posts_stream(spark, folder, EVENTS_SCHEMA))


def _windowed(spark: SparkSession, sf_dir: str, window: Column, keys: list[str], late: bool = False) -> tuple[DataFrame, str]:
    path = new_path(spark, "windows")
    aggs = [F.count("*").alias("n"), F.max("event_id").alias("last_id")]

    def start(stream: Callable[[], DataFrame]) -> None:
        windows.run_append(windows.windowed(stream(), window, keys, DELAY, aggs), path, available_now=True).awaitTermination()

    _arriving(spark, sf_dir, start, late)
    out = windows.read_out(spark, path)
    return out.select(F.unix_micros("window_start").alias("start_us"), F.unix_micros("window_end").alias("end_us"), *keys, "n", "last_id"), path


def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed days per kind; some events arrive too late."""
    return _windowed(spark, sf_dir, windows.tumbling("1 day"), ["event_type"], late=True)[0]


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the stream by fate: in a closed day, in an open one, dropped as late."""
    closed, path = _windowed(spark, sf_dir, windows.tumbling("1 day"), ["event_type"], late=True)
    waiting = windows.waiting(spark, path)
    counter = waiting.schema["value"].dataType.fieldNames()[0]
    held = closed.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_closed")).crossJoin(waiting.agg(F.coalesce(F.sum(F.col("value")[counter]), F.lit(0)).alias("n_open")))
    every = fx.table(spark, sf_dir, "events").agg(F.count("*").alias("n"))
    return held.crossJoin(every).select("n_closed", "n_open", (F.col("n") - F.col("n_closed") - F.col("n_open")).alias("n_late"))  # single rows


def stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed three-day windows, one beginning each day; some events arrive too late."""
    return _windowed(spark, sf_dir, windows.sliding("3 days", "1 day"), [], late=True)[0]


def stream_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed sessions of users, ended by six hours without an event."""
    return _windowed(spark, sf_dir, windows.session("6 hours"), ["user_id"])[0]


def stream_click_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks within an hour before a purchase of the user, from two streams."""
    path = new_path(spark, "pairs")

    def start(stream: Callable[[], DataFrame]) -> None:
        clicks, purchases = (stream().filter(F.col("event_type") == kind) for kind in ("click", "purchase"))
        pairs = windows.joined_within(clicks, purchases, "user_id", "60 MINUTES", DELAY)
        rows = pairs.select(F.col("earlier.event_id").alias("click_id"), F.col("later.event_id").alias("purchase_id"))
        windows.run_append(rows, path, available_now=True).awaitTermination()

    _arriving(spark, sf_dir, start)
    return windows.read_out(spark, path)


def stream_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed visits of users, numbered, with the user's totals so far; three days without an event forget a user."""
    path = new_path(spark, "visits")

    def start(stream: Callable[[], DataFrame]) -> None:
        cents = stream().withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
        visits.run_visits(visits.visits(cents, "user_id", "ts", "cents", DELAY), path, available_now=True).awaitTermination()

    _arriving(spark, sf_dir, start)
    return windows.read_out(spark, path)


QUERIES = {
    f.__name__: f
    for f in (join_asof, join_asof_click, join_overlap, stream_tumbling, stream_late_rows, stream_sliding, stream_session, stream_click_purchase, stream_visits)
}

# Arrival, watermark at arrival (newest time of earlier parts less the delay), and what is late for a window.
_ARRIVED = f"""arrived AS (
  SELECT *, CASE WHEN event_id % {LATE} = 0 THEN least(own + 2, {PARTS - 1}) ELSE own END AS part
  FROM (SELECT *, (event_id * {PARTS}) // ((SELECT max(event_id) FROM events) + 1) AS own FROM events)
),
mark AS (
  SELECT part, max(newest) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL {DELAY} AS wm
  FROM (SELECT part, max(ts) AS newest FROM arrived GROUP BY part)
),
final AS (SELECT max(ts) - INTERVAL {DELAY} AS wm FROM events)"""
_DAYS = f"""WITH {_ARRIVED},
placed AS (
  SELECT a.*, d AS s, d + INTERVAL {{length}} AS e, wm
  FROM arrived a JOIN mark USING (part), (SELECT unnest(range({{slots}})) AS k), LATERAL (SELECT date_trunc('day', ts) - k * INTERVAL 1 day AS d)
),
kept AS (SELECT * FROM placed WHERE wm IS NULL OR e > date_trunc('milliseconds', wm))"""
_TUMBLING = _DAYS.format(length="1 day", slots=1)

SQL = {
    "join_asof": """WITH kinds AS (SELECT DISTINCT event_type AS kind FROM events)
SELECT a.event_id, b.event_id AS prev_id, b.event_type AS prev_type
FROM events a ASOF LEFT JOIN (SELECT * FROM events, kinds WHERE kind <> event_type) b
  ON a.user_id = b.user_id AND a.event_type = b.kind AND a.ts > b.ts""",
    "join_asof_click": """SELECT a.event_id, b.event_id AS click_id, epoch_us(a.ts) AS at_us, epoch_us(b.ts) AS click_us
FROM (SELECT * FROM events WHERE event_type = 'purchase') a ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') b
  ON a.user_id = b.user_id AND a.ts >= b.ts""",
    "join_overlap": f"""SELECT l_orderkey, l_linenumber, l_suppkey, other.o_orderkey
FROM lineitem JOIN orders own ON l_orderkey = own.o_orderkey JOIN orders other ON own.o_custkey = other.o_custkey
WHERE other.o_orderkey <> l_orderkey AND l_shipdate < other.o_orderdate + INTERVAL {WINDOW_DAYS} day
  AND other.o_orderdate < l_shipdate + CAST(l_quantity AS INTEGER) * INTERVAL 1 day""",
    "stream_tumbling": f"""{_TUMBLING}
SELECT epoch_us(s) AS start_us, epoch_us(e) AS end_us, event_type, count(*) AS n, max(event_id) AS last_id
FROM kept WHERE e <= (SELECT wm FROM final) GROUP BY ALL""",
    "stream_late_rows": f"""{_TUMBLING}
SELECT count(*) FILTER (WHERE e <= (SELECT wm FROM final)) AS n_closed, count(*) FILTER (WHERE e > (SELECT wm FROM final)) AS n_open,
  (SELECT count(*) FROM events) - count(*) AS n_late FROM kept""",
    "stream_sliding": f"""{_DAYS.format(length="3 days", slots=3)}
SELECT epoch_us(s) AS start_us, epoch_us(e) AS end_us, count(*) AS n, max(event_id) AS last_id
FROM kept WHERE e <= (SELECT wm FROM final) GROUP BY ALL""",
    "stream_session": f"""WITH marked AS (
  SELECT *, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 6 hours, true)::INT AS fresh FROM events),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM marked),
sessions AS (SELECT user_id, min(ts) AS s, max(ts) + INTERVAL 6 hours AS e, count(*) AS n, max(event_id) AS last_id FROM numbered GROUP BY user_id, session)
SELECT epoch_us(s) AS start_us, epoch_us(e) AS end_us, user_id, n, last_id FROM sessions
WHERE e <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL {DELAY} FROM events)""",
    "stream_visits": f"""WITH marked AS (
  SELECT *, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 6 hours, true)::INT AS fresh FROM events),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM marked),
visits AS (SELECT user_id, min(ts) AS s, max(ts) AS e, count(*) AS n, sum(CAST(round(coalesce(value, 0) * 100) AS BIGINT)) AS total FROM numbered GROUP BY user_id, session),
apart AS (SELECT *, coalesce(s - lag(e) OVER (PARTITION BY user_id ORDER BY s) >= INTERVAL 72 hours, true)::INT AS anew FROM visits),
spells AS (SELECT *, sum(anew) OVER (PARTITION BY user_id ORDER BY s) AS spell FROM apart)
SELECT user_id AS "user", row_number() OVER w AS visit, epoch_us(s) AS first_us, epoch_us(e) AS last_us, n, CAST(total AS BIGINT) AS total,
  CAST(sum(n) OVER w AS BIGINT) AS n_so_far, CAST(sum(total) OVER w AS BIGINT) AS total_so_far
FROM spells WHERE e + INTERVAL 6 hours <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL {DELAY} FROM events)
WINDOW w AS (PARTITION BY user_id, spell ORDER BY s)""",
    "stream_click_purchase": """SELECT c.event_id AS click_id, p.event_id AS purchase_id FROM events c JOIN events p USING (user_id)
WHERE c.event_type = 'click' AND p.event_type = 'purchase' AND p.ts >= c.ts AND p.ts <= c.ts + INTERVAL 60 minutes""",
}
