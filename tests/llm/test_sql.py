"""The queries that SQL can express, against DuckDB."""

from __future__ import annotations

import pytest
from compare import connect, differences
from helpers import SMALL

from wardbook.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", SQL)
def test_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SMALL), con, SQL[name]) == []
