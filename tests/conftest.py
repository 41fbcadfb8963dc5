import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.environ.get("TABKIT_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[8]").appName("tabkit-tests")
               .config("spark.sql.shuffle.partitions", "8").config("spark.default.parallelism", "8")
               .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
               .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def tables(spark):
    def read(name, sf="0.01"):
        return spark.read.parquet(f"{DATA}/sf{sf}/{name}.parquet")
    return read
