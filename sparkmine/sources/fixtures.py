"""Example inputs for every operator, derived from the driver tables.

The SQL texts run unchanged in Spark and in the checking engine; Spark
receives the tables as named DataFrames, the other side reads them by name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.functions.text import tokens
from sparkmine.operators.ratings import dedup_last
from sparkmine.operators.text import by_document
from sparkmine.plans.workspace import spread

SURVEY_SQL = """
SELECT o.o_orderkey AS resp_id,
  CASE WHEN c.c_custkey % 61 = 0 THEN NULL ELSE n.n_name END AS country,
  CASE WHEN o.o_orderkey % 97 = 0 THEN 'NA' WHEN o.o_orderkey % 89 = 0 THEN '0'
       WHEN o.o_orderkey % 83 = 0 THEN NULL WHEN o.o_orderkey % 79 = 0 THEN '12k'
       ELSE concat(CAST(CAST(floor(o.o_totalprice / 1000) AS BIGINT) AS STRING), ',',
                   lpad(CAST(CAST(floor(o.o_totalprice) AS BIGINT) % 1000 AS STRING), 3, '0')) END AS salary,
  CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Monthly' WHEN '2-HIGH' THEN 'Weekly'
       WHEN '3-MEDIUM' THEN 'Yearly' WHEN '5-LOW' THEN 'NA' ELSE NULL END AS salary_type
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
                JOIN {nation} n ON c.c_nationkey = n.n_nationkey
"""

REVIEWS_SQL = """
SELECT o.o_custkey AS user_id, l.l_partkey AS item_id,
  CAST(floor((l.l_quantity - 1) / 10) + 1 AS DOUBLE) AS rating,
  l.l_orderkey AS ord1, l.l_linenumber AS ord2, l.l_suppkey AS ord3,
  l.l_orderkey % 5 = 0 OR o.o_custkey % 10 = 0 OR l.l_partkey % 10 = 0 AS is_test
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
"""

TAGS_SQL = """
SELECT event_id AS pos, ts, concat(event_type, ' ', props) AS text,
  concat(event_type, '_', replace(replace(props, '{{"k": ', ''), '}}', '')) AS tag
FROM {events}
"""

# Every review is on one side of the split. Some users and some items are held
# out whole, so that the test side also asks about unknown ones.
TRAIN_WHERE = "NOT is_test"
TEST_WHERE = "is_test"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = {n: table(spark, sf_dir, n) for n in ("orders", "customer", "nation")}
    return spark.sql(SURVEY_SQL, **t)


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = {n: table(spark, sf_dir, n) for n in ("lineitem", "orders")}
    return spark.sql(REVIEWS_SQL, **t)


def _split(spark: SparkSession, sf_dir: str, where: str) -> DataFrame:
    rows = reviews(spark, sf_dir).filter(where)
    return dedup_last(rows, ["user_id", "item_id"], "rating", ["ord1", "ord2", "ord3", "rating"])


def train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir, TRAIN_WHERE)


def test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir, TEST_WHERE)


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(TAGS_SQL, events=table(spark, sf_dir, "events"))


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("text"))
    return spread(rows)  # the test tables are single files


def baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per word occurrence; repeated words are left in."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("text"))
    return by_document(rows).select(
        F.col("doc_id").alias("basket"), F.explode(tokens("text")).alias("item")
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec")
    )
