"""Cubes over the line table, and merged sketches beside exact values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.operators import cubes
from sparkmine.sources import fixtures as fx

SHARES = (0.25, 0.5, 0.9)


def _lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict, dict]:
    lines = fx.table(spark, sf_dir, "lineitem")
    dims = {"l_returnflag": F.col("l_returnflag"), "l_linestatus": F.col("l_linestatus"), "year": F.year("l_shipdate")}
    sums = {"quantity": F.col("l_quantity").cast("bigint"), "cents": F.round(F.col("l_extendedprice") * 100).cast("bigint")}
    return lines, dims, sums


def _flat(df: DataFrame) -> DataFrame:
    return df.select("l_returnflag", "l_linestatus", F.col("year").cast("bigint").alias("year"), "grouping", "quantity", "cents", "n")


def cube_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of lines for every subset of flag, status and year."""
    return _flat(cubes.cube(*_lines(spark, sf_dir)))


def rollup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of lines by flag, by flag and status, and by all three."""
    return _flat(cubes.rollup(*_lines(spark, sf_dir)))


def grouping_sets_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of lines by flag and year, by status, and of all."""
    lines, dims, sums = _lines(spark, sf_dir)
    return _flat(cubes.grouping_sets(lines, dims, [["l_returnflag", "year"], ["l_linestatus"], []], sums))


def sketch_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per kind of event: sketches of days merged, held against the exact values. Each
    flag says that an estimate keeps its bound."""
    events = fx.table(spark, sf_dir, "events").select("event_type", "user_id", F.round(F.col("value") * 100).cast("bigint").alias("cents"), "props", F.to_date("ts").alias("day"))
    days = cubes.sketched(events, ["event_type", "day"], "user_id", "cents", "props")
    found = cubes.estimates(cubes.merged(days, ["event_type"]), SHARES, 1)
    exact = events.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"), F.count("cents").alias("n_cents"))
    below = events.join(found.select("event_type", "at_shares"), "event_type").groupBy("event_type").agg(
        *[F.count_if(F.col("cents") < F.col("at_shares")[i]).alias(f"lt{i}") for i in range(len(SHARES))],
        *[F.count_if(F.col("cents") <= F.col("at_shares")[i]).alias(f"le{i}") for i in range(len(SHARES))],
    )
    joined = found.join(exact, "event_type").join(below, "event_type")
    slack = F.col("n_cents") * cubes.RANK_ERROR + 1
    ranks = [(F.col(f"lt{i}") <= F.col("n_cents") * q + slack) & (F.col(f"le{i}") >= F.col("n_cents") * q - slack) for i, q in enumerate(SHARES)]
    near = F.abs(F.col("n_distinct") - F.col("users")) <= F.col("users") * cubes.DISTINCT_ERROR + 1
    return joined.select("event_type", "n", near.alias("distinct_ok"), (ranks[0] & ranks[1] & ranks[2]).alias("quantiles_ok"), F.col("most")[0]["count"].alias("most_n"))


QUERIES = {f.__name__: f for f in (cube_lines, rollup_lines, grouping_sets_lines, sketch_merge)}

_LINES = """SELECT l_returnflag, l_linestatus, year(l_shipdate) AS year, CAST(grouping(l_returnflag, l_linestatus, year(l_shipdate)) AS BIGINT) AS grouping,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents, count(*) AS n
FROM lineitem GROUP BY """
SQL = {
    "cube_lines": _LINES + "CUBE (l_returnflag, l_linestatus, year(l_shipdate))",
    "rollup_lines": _LINES + "ROLLUP (l_returnflag, l_linestatus, year(l_shipdate))",
    "grouping_sets_lines": _LINES + "GROUPING SETS ((l_returnflag, year(l_shipdate)), (l_linestatus), ())",
    # Fewer distinct items than counters: the count of the most frequent one is exact.
    "sketch_merge": """SELECT event_type, CAST(sum(n) AS BIGINT) AS n, true AS distinct_ok, true AS quantiles_ok, max(n) FILTER (WHERE props IS NOT NULL) AS most_n
FROM (SELECT event_type, props, count(*) AS n FROM events GROUP BY ALL) GROUP BY event_type""",
}
