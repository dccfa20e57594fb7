"""Batch and stream readers. Schemas are fixed, so no reader scans its input
to find out about it; only the survey's header line is looked at."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.functions.text import tracked

SURVEY_SCHEMA = "country STRING, salary STRING, salary_type STRING"
# Column names of the survey file, by our names.
SURVEY_COLUMNS = {"country": "Country", "salary": "Salary", "salary_type": "SalaryType"}
RATINGS_SCHEMA = "user_id STRING, item_id STRING, rating STRING"
BASKETS_SCHEMA = "basket STRING, item STRING"
POSTS_SCHEMA = "id BIGINT, ts TIMESTAMP, text STRING, tags ARRAY<STRING>"
TRACK_WORD = "Data"  # fixed value: word that posts must mention


def read_survey(spark: SparkSession, path: str, columns: dict[str, str] = SURVEY_COLUMNS) -> DataFrame:
    """Survey answers from CSV with a header. Columns are found by name and
    all read as text; further columns are ignored."""
    raw = spark.read.option("header", True).option("escape", '"').csv(path)
    return raw.select(*[F.col(f"`{theirs}`").alias(ours) for ours, theirs in columns.items()])


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Ratings from CSV with a header: user, item, rating; further fields are
    ignored. A rating that is no number stops the read."""
    return read_placed_ratings(spark, path).drop("place")


def read_placed_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Ratings with their ``place``, which grows with file name and line."""
    raw = spark.read.schema(RATINGS_SCHEMA).options(header=True, enforceSchema=True).csv(path)
    fault = F.raise_error(F.concat(F.lit("malformed rating: "), F.coalesce("rating", F.lit("none"))))
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("line"))
    rating = F.coalesce(F.col("rating").try_cast("double"), fault.cast("double"))
    return raw.select("user_id", "item_id", rating.alias("rating"), place.alias("place"))


def read_baskets(spark: SparkSession, path: str) -> DataFrame:
    """``basket,item`` lines without a header; a line that lacks either is no
    item of a basket and is left out."""
    return spark.read.schema(BASKETS_SCHEMA).csv(path).filter("basket IS NOT NULL AND item IS NOT NULL")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One document per line. Ids are unique, not consecutive, and grow with
    the lines of a file."""
    lines = spark.read.text(path)
    return lines.select(F.monotonically_increasing_id().alias("doc_id"), F.col("value").alias("text"))


def read_posts_stream(
    spark: SparkSession,
    path: str,
    schema: str = POSTS_SCHEMA,
    track: str | None = None,
    files_per_batch: int | None = None,
    text_col: str = "text",
) -> DataFrame:
    """Posts arriving as parquet files under ``path`` (a folder or a glob),
    cut to those that mention ``track``."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    posts = reader.parquet(path)
    return track_filter(posts, track, text_col) if track else posts


def track_filter(posts: DataFrame, word: str = TRACK_WORD, text_col: str = "text") -> DataFrame:
    """Posts that mention ``word`` in any case."""
    return posts.filter(tracked(text_col, word))
