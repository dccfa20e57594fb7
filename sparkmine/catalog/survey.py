"""Survey queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.functions.text import strip_commas
from sparkmine.operators import layout, survey
from sparkmine.plans.workspace import new_path
from sparkmine.sources import fixtures as fx
from sparkmine.sources import readers, sinks

FX = "fx_survey AS (" + fx.SURVEY_SQL.format(orders="orders", customer="customer", nation="nation") + ")"
GIVEN = FX + """,
given AS (SELECT * FROM fx_survey WHERE replace(salary, ',', '') <> '0' AND salary <> 'NA'),
yearly AS (
  SELECT *, TRY_CAST(replace(salary, ',', '') AS DOUBLE) *
    CASE WHEN salary_type = 'Monthly' THEN 12 WHEN salary_type = 'Weekly' THEN 52
         WHEN salary_type IS NOT NULL THEN 1 END AS annual_salary
  FROM given)
"""
STATS = GIVEN + """,
stats AS (
  SELECT country, count(*) AS n, min(annual_salary) AS min_salary,
         max(annual_salary) AS max_salary, avg(annual_salary) AS avg_salary
  FROM yearly WHERE country IS NOT NULL GROUP BY country HAVING count(salary_type) > 0)
"""


def src_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "survey-csv")
    rows = fx.survey(spark, sf_dir)
    named = [F.col(ours).alias(theirs) for ours, theirs in readers.SURVEY_COLUMNS.items()]
    rows.select("resp_id", *named).write.option("header", True).csv(path)
    return readers.read_survey(spark, path)


def flt_has_salary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey.with_salary(fx.survey(spark, sf_dir))


def fn_strip_commas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.survey(spark, sf_dir).select("resp_id", strip_commas("salary").alias("salary_text"))


def prj_annual_salary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = survey.with_salary(fx.survey(spark, sf_dir))
    return survey.annual_salary(rows).select("resp_id", "annual_salary")


def set_union_salaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = survey.with_salary(fx.survey(spark, sf_dir))
    return survey.annual_salary_by_union(rows).select("resp_id", "annual_salary")


def agg_salary_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey.salary_counts(fx.survey(spark, sf_dir))


def _rounded(stats: DataFrame) -> DataFrame:
    return stats.withColumn("avg_salary", F.round("avg_salary", 6))


def agg_salary_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(survey.salary_stats(fx.survey(spark, sf_dir))).orderBy("country")


def join_salary_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(survey.salary_stats_by_join(fx.survey(spark, sf_dir)))


def rpt_salary_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey.format_salary_counts(survey.salary_counts(fx.survey(spark, sf_dir)))


def rpt_salary_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey.format_salary_stats(survey.salary_stats(fx.survey(spark, sf_dir)))


def partition_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.survey(spark, sf_dir).select("resp_id", "country")
    both = layout.partition_profile(rows, 2).unionByName(layout.partition_profile(rows, 2, "country"))
    return both.groupBy("layout").agg(F.count("*").alias("partitions"), F.sum("n").alias("n_rows"))


def partition_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partition report, written and read back: partitions and rows by layout."""
    rows = fx.survey(spark, sf_dir).select("resp_id", "country")
    path = new_path(spark, "partition-report")
    sinks.write_partition_report(layout.partition_profile(rows, 2).unionByName(layout.partition_profile(rows, 2, "country")), path)
    report = spark.read.schema("layout STRING, partition_id BIGINT, n BIGINT").csv(path)
    return report.groupBy("layout").agg(F.countDistinct("partition_id").alias("partitions"), F.sum("n").alias("n"))


def partition_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every country lies in one partition, with all its rows."""
    return layout.key_spread(fx.survey(spark, sf_dir).select("resp_id", "country"), 2, "country")


_ROUNDED_STATS = f"""WITH {STATS}
SELECT country, n, min_salary, max_salary, round(avg_salary, 6) AS avg_salary FROM stats"""

QUERIES = {
    f.__name__: f
    for f in (
        src_survey,
        flt_has_salary,
        fn_strip_commas,
        prj_annual_salary,
        set_union_salaries,
        agg_salary_counts,
        agg_salary_stats,
        join_salary_stats,
        rpt_salary_counts,
        rpt_salary_stats,
        partition_profile,
        partition_rows,
        partition_keys,
    )
}

SQL = {
    "partition_rows": f"""WITH {FX} SELECT layout, CAST(2 AS BIGINT) AS partitions, count(*) AS n
FROM fx_survey, (SELECT unnest(['Standard', 'Partition']) AS layout) GROUP BY layout""",
    "src_survey": f"WITH {FX} SELECT country, salary, salary_type FROM fx_survey",
    "flt_has_salary": f"WITH {GIVEN} SELECT * FROM given",
    "fn_strip_commas": f"WITH {FX} SELECT resp_id, replace(salary, ',', '') AS salary_text FROM fx_survey",
    "prj_annual_salary": f"WITH {GIVEN} SELECT resp_id, annual_salary FROM yearly",
    "set_union_salaries": f"""WITH {GIVEN}
SELECT resp_id, annual_salary FROM yearly WHERE salary_type IS NOT NULL""",
    "agg_salary_counts": f"""WITH {GIVEN}
SELECT country, count(*) AS n, false AS is_total FROM given GROUP BY country
UNION ALL SELECT NULL, count(*), true FROM given""",
    "agg_salary_stats": _ROUNDED_STATS,
    "join_salary_stats": _ROUNDED_STATS,
    "rpt_salary_counts": f"""WITH {GIVEN}
SELECT replace(country, ',', '') AS label, count(*) AS n FROM given GROUP BY country
UNION ALL SELECT 'Total', count(*) FROM given""",
    "rpt_salary_stats": f"""WITH {STATS}
SELECT replace(country, ',', '') AS country, CAST(least(n, 2147483647) AS INTEGER) AS n,
  CAST(trunc(least(greatest(min_salary, -2147483648), 2147483647)) AS INTEGER) AS min_salary,
  CAST(trunc(least(greatest(max_salary, -2147483648), 2147483647)) AS INTEGER) AS max_salary,
  round(avg_salary, 2) AS avg_salary
FROM stats""",
    "partition_keys": f"""WITH {FX}
SELECT country, CAST(1 AS BIGINT) AS partitions, count(*) AS n FROM fx_survey GROUP BY country""",
    "partition_profile": f"""WITH {FX}
SELECT layout, CAST(2 AS BIGINT) AS partitions, count(*) AS n_rows
FROM fx_survey, (VALUES ('Standard'), ('Partition')) AS v(layout) GROUP BY layout""",
}
