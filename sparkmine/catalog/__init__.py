"""Registered queries: each runs an operator over the driver tables and, where
SQL can say the same, carries the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkmine.catalog import cubes, itemsets, ratings, stream, survey, temporal, text
from sparkmine.plans.workspace import configure

Query = Callable[[SparkSession, str], DataFrame]
MODULES = (survey, ratings, itemsets, text, stream, temporal, cubes)


def _configured(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    return run


def all_queries() -> dict[str, Query]:
    return {name: _configured(q) for m in MODULES for name, q in m.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
