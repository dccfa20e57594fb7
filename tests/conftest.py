from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from sparkmine.plans.workspace import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("work")
    folders = {"spark.sql.warehouse.dir": str(root / "warehouse"), "spark.checkpoint.dir": str(root)}
    session = local_session(4, "tests", **folders)
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""

    def collect(df, *cols):
        df = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
