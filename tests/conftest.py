from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from wardbook.operators.joins import FEW_KEYS_CONF, ROWS_PER_SLOT_CONF  # noqa: E402
from wardbook.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("8", "tests", **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints"))})
    yield session
    session.stop()


@pytest.fixture()
def few_rows_per_slot(spark):
    """Every key with more than three rows counts as hot, and no number of keys as few."""
    spark.conf.set(ROWS_PER_SLOT_CONF, "3")
    spark.conf.set(FEW_KEYS_CONF, "0")
    yield
    spark.conf.unset(ROWS_PER_SLOT_CONF)
    spark.conf.unset(FEW_KEYS_CONF)


@pytest.fixture(scope="session")
def tables(spark):
    from wardbook.sources.standins import standin_tables

    return standin_tables(spark, SMALL)


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))
