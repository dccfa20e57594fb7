"""Event-time windows and joins of endless streams.

All state lives in Spark's state store and is given up by the watermark: a window is
written once, when the watermark has passed its end, and rows that come later for it
are dropped. A stream that is started again on the same folder goes on where it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkmine.streaming.state import TRIGGER


def tumbling(length: str, at: str = "ts") -> Column:
    return F.window(at, length)


def sliding(length: str, step: str, at: str = "ts") -> Column:
    return F.window(at, length, step)


def session(gap: str, at: str = "ts") -> Column:
    return F.session_window(at, gap)


def windowed(rows: DataFrame, window: Column, keys: list[str], delay: str, aggs: list[Column], at: str = "ts") -> DataFrame:
    """``window_start, window_end``, ``keys`` and ``aggs`` per window and key. On a
    stream a window comes out once the newest time seen is ``delay`` past its end."""
    grouped = rows.withWatermark(at, delay).groupBy(window.alias("w"), *keys).agg(*aggs)
    return grouped.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *[c for c in grouped.columns if c != "w"])


def joined_within(left: DataFrame, right: DataFrame, key: str, within: str, delay: str, at: str = "ts") -> DataFrame:
    """Pairs of rows with one key, as structs ``earlier`` and ``later``, the right row
    at or up to ``within`` after the left one. On streams both sides wait in state only
    as long as the watermarks allow a partner to come."""

    def side(df: DataFrame, name: str) -> DataFrame:
        row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)
        return df.select(F.col(key).alias(f"{name}_key"), F.col(at).alias(f"{name}_at"), row).withWatermark(f"{name}_at", delay)

    a, b = side(left, "earlier"), side(right, "later")
    limit = F.col("earlier_at") + F.expr(f"INTERVAL {within}")
    return a.join(b, (F.col("earlier_key") == F.col("later_key")) & (F.col("later_at") >= F.col("earlier_at")) & (F.col("later_at") <= limit)).select("earlier", "later")


def run_append(rows: DataFrame, path: str, available_now: bool = False) -> StreamingQuery:
    """Append what the stream settles to the table that ``read_out`` reads."""
    trigger = {"availableNow": True} if available_now else {"processingTime": TRIGGER}
    writer = rows.writeStream.outputMode("append").option("checkpointLocation", f"{path}/checkpoint").option("path", f"{path}/out")
    return writer.format("parquet").trigger(**trigger).start()


def read_out(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/out")


def waiting(spark: SparkSession, path: str) -> DataFrame:
    """Groups that are still open in the state of an aggregation: ``key`` and ``value``
    as the state store holds them."""
    return spark.read.format("statestore").load(f"{path}/checkpoint").select("key", "value")
