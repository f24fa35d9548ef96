import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


def build(**extra):
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build()
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.stop()
        session = build(**{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF
