"""Every registered query next to its SQL, on the smallest tables."""

from __future__ import annotations

import pathlib

import pytest

import __spark_entry__ as spark_entry
from landfall.testbed import oracles
from landfall.testbed.queries import QUERIES
from tests.compare import connect, difference

SF_DIR = spark_entry.SMOKE_DIR
ORACLES = oracles.oracle_sql()

pytestmark = pytest.mark.skipif(not pathlib.Path(SF_DIR).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(spark_entry.queries()) and set(ORACLES) <= set(spark_entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    assert difference(spark_entry.queries()[name](spark, SF_DIR), con, ORACLES[name]) is None


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.columns == ["port_name", "state_name", "immigrant_count"] and df.count() > 0


@pytest.mark.parametrize("name", ["clean_arrivals", "fact_arrivals", "labels_ports", "q_population", "dim_time"])
def test_no_python_in_the_plan(spark, name):
    plan = spark_entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan


def test_days_are_collected_in_one_scan(spark):
    plan = spark_entry.queries()["dim_time"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert sum("FileScan" in line and "l_shipdate" in line for line in plan.splitlines()) == 1


def test_counts_happen_before_the_names_are_joined(spark):
    plan = spark_entry.queries()["q_port_state"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("state_name") < plan.index("partial_count") and plan.count("partial_count") == 1
