from __future__ import annotations

import pytest
from compare import connect, differences
from conftest import SMALL

from wardbook.sources import schemas
from wardbook.sources.standins import VIEWS, duckdb_views, standin_tables


def test_a_view_for_each_table():
    assert set(VIEWS) == set(schemas.TABLES)


@pytest.mark.parametrize("name", VIEWS)
def test_view_is_the_same_in_both_engines_and_fits_the_schema(spark, name):
    df = standin_tables(spark, SMALL)[name]
    assert {f.name: f.dataType for f in df.schema} == {f.name: f.dataType for f in schemas.schema(name)}
    padded = schemas.padded(name)
    columns = ", ".join(f"rtrim(v.{c}) AS {c}" if c in padded else f"v.{c}" for c in schemas.columns(name))
    assert differences(df, connect(SMALL), duckdb_views(f"SELECT {columns} FROM {name} v")) == []


def test_patient_zero_is_no_patient(tables):
    assert tables.patients.where("patno = 0").count() == 0
    assert tables.rmbed.where("pat_no = 0").count() > 0
