import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from presswire import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        master="local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Value of a column expression over one input."""

    def run(value, expression, kind="string"):
        return spark.createDataFrame([(value,)], f"x {kind}").select(expression).first()[0]

    return run
