"""Every registered query against DuckDB on the smallest data set, and rules that all plans keep."""

import os

import pytest

import __spark_entry__ as driver
from reelcheck.compare import difference, oracle_connection
from reelcheck.oracle import ORACLE
from reelcheck.registry import QUERIES

SF_DIR = os.environ.get("REGISTERED_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_duckdb(spark, oracle, name):
    assert difference(spark, oracle, SF_DIR, name) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_rules(spark, name):
    """No Python in the plan, no cartesian product, and no nested-loop join."""
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython"):
        assert banned not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["movies_per_year"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "o_orderdate" in line]
    assert scans and all("o_totalprice" not in s for s in scans)


def test_entry(spark):
    assert driver.entry(spark).count() > 0
