"""Salary analytics over survey answers ``(country, salary, salary_type)``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.functions.salary import (
    PAY_PERIODS,
    annual_factor,
    has_salary,
    salary_number,
    saturated_int,
    two_decimals,
)
from sparkmine.functions.text import strip_commas
from sparkmine.plans.workspace import materialize


def with_salary(df: DataFrame) -> DataFrame:
    """Answers that give a salary."""
    return df.filter(has_salary())


def annual_salary(df: DataFrame, factors: dict[str, int] = PAY_PERIODS, default: int = 1) -> DataFrame:
    """Add ``annual_salary``; null where the pay period is null or the salary
    is no number."""
    return df.withColumn(
        "annual_salary", salary_number() * annual_factor("salary_type", factors, default)
    )


def annual_salary_by_union(df: DataFrame, factors: dict[str, int] = PAY_PERIODS, default: int = 1) -> DataFrame:
    """The same rows built as one branch per pay period, put together with
    UNION ALL. The input is written once, and the branches read what was
    written; kept as the spelled-out form."""
    df = materialize(df, "answers")
    kind = F.col("salary_type")
    branches = [df.filter(~kind.isin(*factors)).withColumn("annual_salary", salary_number() * F.lit(default))]
    for period, times in factors.items():
        branches.append(df.filter(kind == period).withColumn("annual_salary", salary_number() * F.lit(times)))
    return reduce(DataFrame.unionByName, branches)


def salary_counts(df: DataFrame) -> DataFrame:
    """Answers with a salary per country plus the grand total, in one pass."""
    return (
        with_salary(df)
        .rollup("country")
        .agg(F.count("*").alias("n"), (F.grouping_id() == 1).alias("is_total"))
        .select("country", "n", "is_total")
    )


def salary_stats(df: DataFrame) -> DataFrame:
    """Count, smallest, largest and mean annual salary per country.

    One scan and one hash exchange. Countries whose answers all lack a pay
    period are left out, as is the null country. The count covers every
    answer with a salary.
    """
    return (
        annual_salary(with_salary(df))
        .filter(F.col("country").isNotNull())
        .groupBy("country")
        .agg(
            F.count("*").alias("n"),
            F.count("salary_type").alias("n_annual"),
            F.min("annual_salary").alias("min_salary"),
            F.max("annual_salary").alias("max_salary"),
            F.avg("annual_salary").alias("avg_salary"),
        )
        .filter(F.col("n_annual") > 0)
        .drop("n_annual")
    )


def salary_stats_by_join(df: DataFrame) -> DataFrame:
    """The same table as two aggregates joined on the country: the count of all
    answers with a salary, and the figures of those with a pay period. The
    answers are written once with their annual salary."""
    given = materialize(annual_salary(with_salary(df)).select("country", "salary_type", "annual_salary"), "answers")
    counts = given.groupBy("country").agg(F.count("*").alias("n"))
    figures = given.filter(F.col("salary_type").isNotNull()).groupBy("country")
    salary = F.col("annual_salary")
    figures = figures.agg(F.min(salary).alias("min_salary"), F.max(salary).alias("max_salary"), F.avg(salary).alias("avg_salary"))
    return counts.join(figures, "country")


def format_salary_counts(counts: DataFrame) -> DataFrame:
    """Report rows ``(label, n)``: the total first, then countries in order."""
    label = F.when(F.col("is_total"), F.lit("Total")).otherwise(strip_commas("country"))
    return counts.orderBy(F.desc("is_total"), "country").select(label.alias("label"), "n")


def format_salary_stats(stats: DataFrame) -> DataFrame:
    """Report rows: whole numbers held in 32 bits, mean to two decimals."""
    return stats.orderBy("country").select(
        strip_commas("country").alias("country"),
        F.col("n").cast("double").alias("_n"),
        "min_salary",
        "max_salary",
        "avg_salary",
    ).select(
        "country",
        saturated_int("_n").alias("n"),
        saturated_int("min_salary").alias("min_salary"),
        saturated_int("max_salary").alias("max_salary"),
        two_decimals("avg_salary").alias("avg_salary"),
    )
