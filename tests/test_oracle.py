"""Every registered query against its SQL, also with nearly every key treated as hot."""

from __future__ import annotations

import pytest
from compare import connect, differences
from conftest import SMALL

import __spark_entry__ as entry_points

SQL = entry_points.oracle_sql()
QUERIES = {n: q for n, q in entry_points.queries().items() if n in entry_points.REPORTS or n == "table_probe"}


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SMALL), con, SQL[name]) == []


@pytest.mark.parametrize("name", [n for n in QUERIES if n != "table_probe"])
def test_matches_sql_when_keys_are_hot(spark, con, name, few_rows_per_slot):
    assert differences(QUERIES[name](spark, SMALL), con, SQL[name]) == []


def test_entry(spark):
    df = entry_points.entry(spark)
    assert len(df.columns) == 16
    assert df.count() > 0

