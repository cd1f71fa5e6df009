import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from tidemark.plans import Tables

    return Tables(spark, DATA)


@pytest.fixture(scope="session")
def duck():
    from tests.compare import connect

    return connect(DATA)


@pytest.fixture
def cut_everywhere(monkeypatch):
    """Cut every key with more than a few rows into slices, as only hot keys of large input are."""
    from tidemark.operators import slices

    monkeypatch.setattr(slices, "ROWS_PER_SLICE", 9)


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())
