"""Every registered query against its SQL, on the smallest tables."""

import os
import re

import pytest
from compare import connect, differences, type_differences

import __spark_entry__ as entry_point
import workload

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert workload.queries().keys() == workload.oracle_sql().keys()
    assert workload.queries().keys() <= entry_point.queries().keys()


@pytest.mark.parametrize("name", workload.queries())
def test_same_rows(spark, con, name):
    df = entry_point.queries()[name](spark, SF_DIR)
    sql = entry_point.oracle_sql()[name]
    assert type_differences(df, con, sql) == []
    assert differences(df, con, sql) == []
    shown = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoop|Python", shown)


def test_flagship(spark):
    assert entry_point.entry(spark).count() > 0
