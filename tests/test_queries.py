"""Every registered query on the smallest given tables, beside its SQL where it has one."""

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

import __spark_entry__ as entry  # noqa: E402
from conftest import plan_of  # noqa: E402
from tools.check_queries import compare, oracle_connection  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="given tables are not here")

# Rows expected of the queries that SQL cannot express; the smallest tables have 5 series.
ROWS_ONLY = {
    "adf_test": 5, "arima_search": 5 * 48, "arima_forecast": 5 * 365,
    "forecast_published": 5 * 365, "forecast_summary": 5, "model_trials": 10,
}


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    problem = compare(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name])
    assert problem is None, problem


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_without_sql(spark, name):
    n = entry.queries()[name](spark, SF_DIR).count()
    assert n == ROWS_ONLY.get(name, n) and n > 0


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    flagship = entry.entry(spark)
    assert flagship.count() > 0


@pytest.mark.parametrize(
    "name", ["month_rollup", "measure_by_station_name", "page_take_while", "event_positions", "acf", "residual_histogram"]
)
def test_no_nested_loops_or_products(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_scan_is_pruned_and_filtered(spark):
    plan = plan_of(entry.queries()["scan_project_filter"](spark, SF_DIR))
    assert "GreaterThanOrEqual(l_quantity,25.0)" in plan
    assert "l_comment" not in plan and "l_tax" not in plan and "l_shipdate" not in plan
