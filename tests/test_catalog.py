"""Every registered query beside its SQL, at the smallest scale."""

from __future__ import annotations

import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as entry  # noqa: E402
import check  # noqa: E402
from conftest import plan_of  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return check.connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in SQL:
        assert check.compare(df, con.sql(SQL[name])) == ""
    else:
        assert df.count() > 0


def test_sql_belongs_to_queries():
    assert SQL.keys() <= QUERIES.keys()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_scans_read_the_columns_they_need(spark):
    plan = plan_of(QUERIES["agg_salary_stats"](spark, SF_DIR))
    orders = re.search(r"ReadSchema: struct<(o_[^>]*)>", plan).group(1)
    assert set(re.findall(r"(o_\w+):", orders)) == {"o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"}
