import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """rows(schema, (..), (..)) -> DataFrame"""
    return lambda schema, *data: spark.createDataFrame(list(data), schema)


@pytest.fixture
def values(spark):
    """values(expression over column x, inputs) -> list of results"""
    from pyspark.sql import functions as F

    def run(fn, inputs, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
        return [r.y for r in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]

    return run
