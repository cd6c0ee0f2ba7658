import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from gistmill.session import get_spark  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = get_spark(
        "gistmill-tests", "local[4]",
        spark__sql__shuffle__partitions="4", spark__driver__memory="4g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def ws(spark):
    from gistmill.plans.workspace import workspace

    return workspace(spark, SMALL)


@pytest.fixture
def one(spark):
    """Value of a column expression over a single text column ``x``."""

    def value(text, build):
        from pyspark.sql import functions as F

        df = spark.createDataFrame([(text,)], "x string")
        return df.select(build(F.col("x")).alias("y")).first()["y"]

    return value
