"""Itemset queries over the words of documents."""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.functions.text import has_words
from sparkmine.operators import itemsets
from sparkmine.plans.workspace import new_path
from sparkmine.sources import fixtures as fx
from sparkmine.sources import readers

SUPPORT_SHARE = "0.3"

WORDS = """words AS (
  SELECT DISTINCT doc_id AS basket, unnest(string_split(rtrim(lower(text), ' '), ' ')) AS item
  FROM documents),
need AS (SELECT CAST(ceil(0.3 * count(DISTINCT basket)) AS BIGINT) AS support FROM words)"""
ONE = WORDS + """,
one AS (SELECT item, count(*) AS freq FROM words GROUP BY item HAVING count(*) >= (SELECT support FROM need)),
kept AS (SELECT basket, item FROM words WHERE item IN (SELECT item FROM one))"""
TWO = ONE + """,
two AS (
  SELECT a.item AS i1, b.item AS i2, count(*) AS freq
  FROM kept a JOIN kept b ON a.basket = b.basket AND a.item < b.item
  GROUP BY 1, 2 HAVING count(*) >= (SELECT support FROM need))"""
THREE = TWO + """,
three AS (
  SELECT a.item AS i1, b.item AS i2, c.item AS i3, count(*) AS freq
  FROM kept a JOIN kept b ON a.basket = b.basket AND a.item < b.item
              JOIN kept c ON a.basket = c.basket AND b.item < c.item
  GROUP BY 1, 2, 3 HAVING count(*) >= (SELECT support FROM need))"""


def _levels_sql(depth: int) -> str:
    """Frequent sets of every size up to ``depth``, one level after the other;
    levels past the largest set are empty."""
    ctes = [ONE, "t1 AS (SELECT item AS items, item AS last, basket FROM kept)"]
    for k in range(1, depth + 1):
        if k > 1:
            ctes.append(f"""t{k} AS (
  WITH grown AS (SELECT a.items || ',' || b.item AS items, b.item AS last, a.basket
                 FROM t{k - 1} a JOIN kept b ON a.basket = b.basket AND a.last < b.item)
  SELECT * FROM grown WHERE items IN (
    SELECT items FROM grown GROUP BY items HAVING count(*) >= (SELECT support FROM need)))""")
        ctes.append(f"f{k} AS (SELECT items, {k} AS size, count(*) AS freq FROM t{k} GROUP BY items)")
    union = " UNION ALL ".join(f"SELECT * FROM f{k}" for k in range(1, depth + 1))
    return ",\n".join(ctes) + f",\nfound AS ({union})"


DEPTH = 16  # more than the largest set of the test tables
ALL = _levels_sql(DEPTH)


def _support(spark: SparkSession, sf_dir: str) -> int:
    """Support threshold: a fixed share of the documents with any word."""
    n = fx.docs(spark, sf_dir).filter(has_words("text")).count()
    return math.ceil(Fraction(SUPPORT_SHARE) * n)


def _found(spark: SparkSession, sf_dir: str, max_len: int | None = None, method: str = "fpgrowth") -> DataFrame:
    return itemsets.frequent_itemsets(fx.baskets(spark, sf_dir), _support(spark, sf_dir), max_len, method)


def _joined(sets: DataFrame) -> DataFrame:
    return sets.withColumn("items", F.array_join("items", ","))


def src_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "baskets-csv")
    fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey").write.csv(path)
    return readers.read_baskets(spark, path)


def basket_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itemsets.basket_dedup(fx.baskets(spark, sf_dir))


def agg_basket_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itemsets.basket_count(fx.baskets(spark, sf_dir))


def _of_size(size: int):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = _found(spark, sf_dir, max_len=size)
        return _joined(found.filter(F.col("size") == size)).select("items", "freq")

    query.__name__ = f"itemsets_{size}"
    return query


def itemsets_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(_found(spark, sf_dir))


def itemsets_fpgrowth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(_found(spark, sf_dir, method="fpgrowth"))


def itemset_support_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many baskets hold each joined candidate of three items, frequent or not."""
    baskets = fx.baskets(spark, sf_dir)
    pairs = itemsets.frequent_itemsets(baskets, _support(spark, sf_dir), 2).filter("size = 2")
    cands = itemsets.candidates(pairs.select("items"))
    return _joined(itemsets.support_count(baskets, cands))


def set_itemset_algebra(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _found(spark, sf_dir, max_len=2).filter("size = 2")
    rows = itemsets.itemset_algebra(pairs.select("items"))
    named = [F.array_join(c, ",").alias(c) for c in ("left", "right", "union", "common")]
    return rows.select(*named, "is_subset", "size").withColumnsRenamed(
        {"left": "left_set", "right": "right_set", "union": "union_set", "common": "common_set"}
    )


def rpt_itemsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itemsets.format_itemsets(_found(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        src_baskets,
        basket_dedup,
        agg_basket_count,
        _of_size(1),
        _of_size(2),
        _of_size(3),
        itemsets_all,
        itemsets_fpgrowth,
        itemset_support_count,
        set_itemset_algebra,
        rpt_itemsets,
    )
}

SQL = {
    "src_baskets": """SELECT CAST(l_orderkey AS VARCHAR) AS basket, CAST(l_partkey AS VARCHAR) AS item
FROM lineitem""",
    "basket_dedup": f"WITH {WORDS} SELECT basket, item FROM words",
    "agg_basket_count": f"WITH {WORDS} SELECT count(DISTINCT basket) AS n_baskets FROM words",
    "itemsets_1": f"WITH {ONE} SELECT item AS items, freq FROM one",
    "itemsets_2": f"WITH {TWO} SELECT concat_ws(',', i1, i2) AS items, freq FROM two",
    "itemsets_3": f"WITH {THREE} SELECT concat_ws(',', i1, i2, i3) AS items, freq FROM three",
    "itemsets_all": f"WITH {ALL} SELECT items, size, freq FROM found",
    "itemsets_fpgrowth": f"WITH {ALL} SELECT items, size, freq FROM found",
    "itemset_support_count": f"""WITH {TWO},
cand AS (SELECT a.i1, a.i2, b.i2 AS i3 FROM two a JOIN two b ON a.i1 = b.i1 AND a.i2 < b.i2)
SELECT concat_ws(',', i1, i2, i3) AS items, count(*) AS freq
FROM cand JOIN kept a ON a.item = i1
  JOIN kept b ON b.item = i2 AND b.basket = a.basket
  JOIN kept c ON c.item = i3 AND c.basket = a.basket
GROUP BY 1""",
    "set_itemset_algebra": f"""WITH {TWO}
SELECT concat_ws(',', a.i1, a.i2) AS left_set, concat_ws(',', b.i1, b.i2) AS right_set,
  concat_ws(',', a.i1, a.i2, b.i2) AS union_set, a.i1 AS common_set, true AS is_subset, 3 AS size
FROM two a JOIN two b ON a.i1 = b.i1 AND a.i2 < b.i2""",
    "rpt_itemsets": f"WITH {ALL} SELECT size, '(' || items || ')' AS itemset FROM found",
}
