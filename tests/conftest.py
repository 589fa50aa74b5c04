"""One local session for all tests."""

from __future__ import annotations

import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kalendra.session import configure  # noqa: E402


def session() -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="kalendra-test-")
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("kalendra-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoint")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    return session()
