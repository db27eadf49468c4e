import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("lakeworks-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture(scope="session")
def clf_df(spark):
    rows = list(
        zip(
            [0, 1, 0, 1, 0, 1, 0, 0, 1, 1],
            [0, 1, 1, 1, 0, 0, 0, 1, 1, 0],
            [0.1, 0.9, 0.6, 0.8, 0.2, 0.4, 0.3, 0.7, 0.85, 0.35],
            list("AAAAABBBBB"),
        )
    )
    return spark.createDataFrame(rows, "target int, prediction int, probability double, group string")


@pytest.fixture(scope="session")
def surv_df(spark):
    rows = list(
        zip(
            [10, 15, 20, 25, 30, 12, 18, 22, 28, 32],
            [1, 0, 1, 0, 1, 1, 0, 1, 0, 1],
            [12, 10, 22, 20, 35, 10, 20, 25, 26, 30],
            list("AAAAABBBBB"),
        )
    )
    return spark.createDataFrame(rows, "time int, event int, prediction int, group string")
