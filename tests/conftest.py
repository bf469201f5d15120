from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(home / "warehouse"))
        .config("spark.checkpoint.dir", str(home / "checkpoint"))
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return TESTDATA


@pytest.fixture(scope="session")
def jts(spark):
    """The geometry library on Spark's class path, as an independent check."""
    return spark._jvm.org.locationtech.jts.io.WKTReader()
