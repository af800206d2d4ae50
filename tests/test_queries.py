"""Every registered query beside its SQL on the smallest data."""

import pytest

import __spark_entry__ as entry
import oracles
from tallyflow.catalog.registry import registered
from tests.compare import differences, duck

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = registered(), oracles.all_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    planned = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in planned and "BroadcastNestedLoopJoin" not in planned and "BatchEvalPython" not in planned
    note = differences(df, con, SQL[name], ties=True)
    assert note in (None, "both sides empty")


def test_entry(spark):
    assert entry.entry(spark).count() > 0
