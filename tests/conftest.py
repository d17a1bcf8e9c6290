import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from commentloom.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("commentloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return configure(session)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def column(spark, fn, values, dtype="string"):
    """Values of a scalar function over a list of inputs, in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, x {dtype}")
    return [r["y"] for r in df.selectExpr("i", f"{fn('x')} AS y").orderBy("i").collect()]
