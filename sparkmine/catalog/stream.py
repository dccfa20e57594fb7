"""Sampling, Bloom and streaming queries over the event table as posts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkmine.functions.text import hashtags
from sparkmine.operators import bloom, sampling
from sparkmine.plans.workspace import new_path
from sparkmine.sources import fixtures as fx
from sparkmine.sources import readers
from sparkmine.streaming import bloom as bloom_stream
from sparkmine.streaming import reservoir as reservoir_stream

SEED = 1
TRACK = "Click"
PROBE_FPP = 0.05
PARTS = 5  # batches the events arrive in

EVENTS_SCHEMA = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"

FX = "fx_tags AS (" + fx.TAGS_SQL.format(events="events") + ")"
_HASH = "CAST(('0x' || substr(md5({x}), 1, 8)) AS BIGINT)"
SAMPLE = FX + f""",
sample AS (SELECT pos AS id, text, tag FROM fx_tags ORDER BY md5('{SEED}:' || pos), pos LIMIT 100)"""
_BLOOM = f""",
seen AS (SELECT tag, min(spot) AS first_pos, count(*) AS n FROM arrived GROUP BY tag),
bits AS (SELECT tag, first_pos, n, {_HASH.format(x="tag")} % 10 AS b0, {_HASH.format(x="tag")} % 30 AS b1 FROM seen),
first_bit AS (SELECT bit, min(first_pos) AS p FROM (
  SELECT b0 AS bit, first_pos FROM bits UNION ALL SELECT b1, first_pos FROM bits) t GROUP BY bit),
judged AS (SELECT b.tag, b.n, f0.p < b.first_pos AND f1.p < b.first_pos AS wrong
  FROM bits b JOIN first_bit f0 ON f0.bit = b.b0 JOIN first_bit f1 ON f1.bit = b.b1)"""
BLOOM = FX + ", arrived AS (SELECT tag, pos AS spot FROM fx_tags)" + _BLOOM
LATE_BLOOM = FX + f""", arrived AS (
  SELECT tag, row_number() OVER (ORDER BY (pos - lo) * {PARTS} // (hi - lo + 1) DESC, pos) AS spot
  FROM fx_tags, (SELECT min(pos) AS lo, max(pos) AS hi FROM fx_tags) ends)""" + _BLOOM
_SCORE = """SELECT CAST(count(*) FILTER (WHERE NOT wrong) AS BIGINT) AS unique_tags,
  CAST(coalesce(sum(n - 1) FILTER (WHERE NOT wrong), 0) AS BIGINT) AS correct,
  CAST(coalesce(sum(n) FILTER (WHERE wrong), 0) AS BIGINT) AS incorrect FROM judged"""


def _as_posts(events: DataFrame) -> DataFrame:
    """Events in the shape of posts; works on streams as on tables."""
    text = F.concat("event_type", F.lit(" "), "props")
    key = F.replace(F.replace("props", F.lit('{"k": ')), F.lit("}"))
    return events.select(
        F.col("event_id").alias("id"), "ts", text.alias("text"), F.array(F.concat("event_type", F.lit("_"), key)).alias("tags")
    )


def _posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_posts(fx.table(spark, sf_dir, "events"))


def _post_stream(spark: SparkSession, path: str) -> DataFrame:
    return _as_posts(readers.read_posts_stream(spark, path, EVENTS_SCHEMA))


def _in_parts(spark: SparkSession, sf_dir: str, run: Callable[[DataFrame], StreamingQuery], late: bool = False) -> None:
    """Events that arrive in ``PARTS`` parts by id, the highest ids first if
    ``late``. The stream goes on from where it was after each of them."""
    events = fx.table(spark, sf_dir, "events")
    ends = events.agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).first()
    span = F.lit((ends["hi"] or 0) - (ends["lo"] or 0) + 1)
    part = F.coalesce(F.floor((F.col("event_id") - F.lit(ends["lo"])) * PARTS / span), F.lit(0))
    folder = new_path(spark, "events")
    for i in reversed(range(PARTS)) if late else range(PARTS):
        events.filter(part == i).write.mode("append").parquet(folder)
        run(_post_stream(spark, folder)).awaitTermination()


def stream_track_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts that mention a word, streamed into a table."""
    path = new_path(spark, "tracked")
    posts = readers.track_filter(_post_stream(spark, f"{sf_dir}/events*.parquet"), TRACK).select("id", "text")
    writer = posts.writeStream.option("checkpointLocation", f"{path}/checkpoint").option("path", f"{path}/out")
    writer.format("parquet").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/out")


def fn_post_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length and hash tags of posts whose tags are written into the text."""
    body = F.concat("text", F.lit(" #"), F.col("tags")[0], F.lit(" #"), F.split("text", " ")[0])
    posts = _posts(spark, sf_dir).select("id", body.alias("text"))
    return posts.select("id", F.length("text").alias("n_chars"), F.array_join(hashtags("text"), " ").alias("tag_list"))


def fn_bloom_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = bloom.bloom_bits(fx.tags(spark, sf_dir).select("pos", "tag"), "tag")
    return marked.select("pos", F.col("bits")[0].alias("bit_1"), F.col("bits")[1].alias("bit_2"))


def sample_reservoir(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.reservoir(_posts(spark, sf_dir), "id", seed=SEED).select("id", "text")


def _sampled(spark: SparkSession, sf_dir: str) -> str:
    path = new_path(spark, "reservoir")
    _in_parts(spark, sf_dir, lambda posts: reservoir_stream.run_reservoir_stream(posts, path, seed=SEED, available_now=True))
    return path


def stream_reservoir(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _sampled(spark, sf_dir)
    n_seen = reservoir_stream.posts_seen(spark, path)
    return reservoir_stream.read_sample(spark, path).select("id", "text", F.lit(n_seen).cast("bigint").alias("n_seen"))


def stream_hot_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.hot_tags(reservoir_stream.read_sample(spark, _sampled(spark, sf_dir)))


def stream_avg_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = reservoir_stream.stream_stats(spark, _sampled(spark, sf_dir))
    return stats.withColumn("avg_length", F.round("avg_length", 6))


def bloom_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom.bloom_report(fx.tags(spark, sf_dir))


def _scored(spark: SparkSession, sf_dir: str, late: bool) -> DataFrame:
    path = new_path(spark, "bloom")
    _in_parts(spark, sf_dir, lambda posts: bloom_stream.run_bloom_stream(bloom_stream.tag_positions(posts), path, available_now=True), late)
    return bloom_stream.read_score(spark, path)


def stream_bloom_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir, late=False)


def stream_bloom_late_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score where posts of lower ids arrive later."""
    return _scored(spark, sf_dir, late=True)


def bloom_probe_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that may have an urgent order."""
    urgent = fx.table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'")
    n = urgent.select(F.countDistinct("o_custkey")).first()[0]
    n_bits = bloom.bloom_size(n, PROBE_FPP)
    bits = bloom.bloom_build(urgent, "o_custkey", n_bits)
    customers = fx.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return bloom.bloom_filter(customers, "c_custkey", bits, n_bits)


QUERIES = {
    f.__name__: f
    for f in (
        stream_track_filter,
        fn_post_features,
        fn_bloom_bits,
        sample_reservoir,
        stream_reservoir,
        stream_hot_tags,
        stream_avg_length,
        bloom_report,
        stream_bloom_report,
        stream_bloom_late_ids,
        bloom_probe_filter,
    )
}


def _probe_sql(key: str) -> str:
    first, second = _HASH.format(x=f"CAST({key} AS VARCHAR)"), _HASH.format(x=f"'+' || {key}")
    return f"({first} + probe * {second}) % n_bits"


SQL = {
    "stream_track_filter": f"WITH {FX} SELECT pos AS id, text FROM fx_tags WHERE contains(lower(text), 'click')",
    "fn_post_features": rf"""WITH {FX},
body AS (SELECT pos AS id, text || ' #' || tag || ' #' || string_split(text, ' ')[1] AS text FROM fx_tags)
SELECT id, CAST(length(text) AS INTEGER) AS n_chars,
  array_to_string(regexp_extract_all(text, '#([\p{{L}}\p{{M}}\p{{N}}_]+)', 1), ' ') AS tag_list FROM body""",
    "fn_bloom_bits": f"""WITH {FX} SELECT pos, {_HASH.format(x="tag")} % 10 AS bit_1,
{_HASH.format(x="tag")} % 30 AS bit_2 FROM fx_tags""",
    "sample_reservoir": f"WITH {SAMPLE} SELECT id, text FROM sample",
    "stream_reservoir": f"WITH {SAMPLE} SELECT id, text, (SELECT count(*) FROM events) AS n_seen FROM sample",
    "stream_hot_tags": f"""WITH {SAMPLE} SELECT tag, count(*) AS n FROM sample GROUP BY tag
ORDER BY n DESC, tag LIMIT 5""",
    "stream_avg_length": f"""WITH {SAMPLE} SELECT (SELECT count(*) FROM events) AS n_seen, count(*) AS n_sample,
round(avg(length(text)), 6) AS avg_length FROM sample""",
    "bloom_report": f"WITH {BLOOM} {_SCORE}",
    "stream_bloom_report": f"WITH {BLOOM} {_SCORE}",
    "stream_bloom_late_ids": f"WITH {LATE_BLOOM} {_SCORE}",
    "bloom_probe_filter": f"""WITH urgent AS (
  SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderpriority = '1-URGENT'),
size AS (SELECT greatest(64, CAST(ceil(-count(*) * ln({PROBE_FPP}::DOUBLE) / (ln(2) * ln(2))) AS BIGINT)) AS n_bits FROM urgent),
each AS (SELECT n_bits, unnest([0, 1, 2]) AS probe FROM size),
bits AS (SELECT DISTINCT {_probe_sql("k")} AS spot FROM urgent, each),
probes AS (SELECT c_custkey, c_name, {_probe_sql("c_custkey")} AS spot FROM customer, each)
SELECT c_custkey, c_name FROM probes GROUP BY 1, 2
HAVING bool_and(spot IN (SELECT spot FROM bits))""",
}
