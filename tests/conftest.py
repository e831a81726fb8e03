import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from duelboard.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Value of a column function for each of several inputs."""
    from pyspark.sql import functions as F

    def run(function, values, kind="string"):
        df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
        rows = df.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()
        return [row["y"] for row in rows]

    return run
