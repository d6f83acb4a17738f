import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from voltatlas.session import LAUNCH_CONF, configure

    builder = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in LAUNCH_CONF.items():
        builder = builder.config(key, value)
    session = configure(builder.getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Values of one text column through an expression, in order."""
    from pyspark.sql import functions as F

    def run(values, expr, dtype="string"):
        df = spark.createDataFrame(list(enumerate(values)), f"i int, v {dtype}")
        rows = df.select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()
        return [r.o for r in rows]

    return run
