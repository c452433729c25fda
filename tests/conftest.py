import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from showledger.session import build_session

    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": 8, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def one(spark):
    """Evaluate Columns over one row."""
    def run(*columns):
        row = spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()
        return row[0] if len(columns) == 1 else tuple(row)

    return run
