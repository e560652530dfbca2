from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from veleta.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def lake(spark, tmp_path):
    """Make lakehouses below the test's own folder."""
    from veleta.sinks import open_lakehouse

    def make(name):
        unique = f"{name}_{tmp_path.name}"
        return open_lakehouse(spark, unique, location=str(tmp_path / name))

    return make


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
