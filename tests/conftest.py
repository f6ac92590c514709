import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyhouse.plans.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(root / "warehouse"),
            "spark.checkpoint.dir": str(root / "checkpoints"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    def make(*texts):
        return spark.createDataFrame([(text,) for text in texts], "value string")

    return make


def rows(df, *columns):
    """Rows as sorted tuples."""
    df = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in df.collect()), key=repr)
