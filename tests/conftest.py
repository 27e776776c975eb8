from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def make_session():
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    builder = (
        SparkSession.builder.master("local[8]").appName("folioloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", scratch + "/checkpoints")
        .config("spark.sql.warehouse.dir", scratch + "/warehouse"))
    # e.g. "spark.sql.autoBroadcastJoinThreshold=-1,spark.sql.adaptive.enabled=false"
    for setting in filter(None, os.environ.get("TEST_SPARK_CONF", "").split(",")):
        builder = builder.config(*setting.split("=", 1))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()
