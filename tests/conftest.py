"""One local session for all tests."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def session() -> SparkSession:
    from adsettle.session import SETTINGS

    builder = SparkSession.builder.master("local[8]").appName("tests")
    for key, value in {
        **SETTINGS,
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.sql.maxMetadataStringLength": "5000",
        "spark.sql.debug.maxToStringFields": "1000",
    }.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    return session()
