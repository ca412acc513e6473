from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session, prepare  # noqa: E402
from tidemark.sources.tables import Tables  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", **{
        "spark.master": "local[8]", "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false", "spark.driver.memory": "6g",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture
def tables(spark, tmp_path):
    return Tables(spark, str(tmp_path / "tables"))


@pytest.fixture
def name():
    from suite.fixtures import fresh_name

    return fresh_name("t")


def rows_of(df, *order):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, str(v)) for v in r])
