"""Operators that SQL can express, against their SQL."""

import os

import pytest
from compare import connect, differences, type_differences

from lakeferry.llm import queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", queries.ORACLES)
def test_same_rows(spark, name):
    con = connect(SF_DIR)
    df = queries.QUERIES[name](spark, SF_DIR)
    assert type_differences(df, con, queries.ORACLES[name]) == []
    assert differences(df, con, queries.ORACLES[name]) == []
