import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from cleanloom.session import tuned

    session = (
        tuned(SparkSession.builder).master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def column(spark):
    """values, f -> what f makes of a text column with those values"""
    from pyspark.sql import functions as F

    def apply(values, f):
        df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
        return [r[0] for r in df.select("i", f(F.col("v")).alias("r")).orderBy("i").select("r").collect()]

    return apply
