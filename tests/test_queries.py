"""Every registered query against its reference SQL, on the smallest data."""

from __future__ import annotations

import os

import pytest
from compare import connect, differences

from catalog.oracle import SQL
from catalog.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert name in SQL
    assert differences(df, con, SQL[name]) == []


def test_compare_notices_a_difference(spark, con):
    df = spark.sql("select 1 as a")
    assert differences(df, con, "select 1 as a") == []
    assert differences(df, con, "select 2 as a") and differences(df, con, "select 1::bigint as a") and differences(df, con, "select 1 as b")


def test_no_python_and_no_nested_loops(spark):
    for name in ("monthly_closings_by_buyer", "fact_procurement", "month_trend", "kpi_scorecard", "grid_rows", "scd2"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(bad in plan for bad in ("BatchEvalPython", "ArrowEvalPython", "NestedLoop", "CartesianProduct")), name
