from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from vayumark.session import RECOMMENDED, local_scratch  # noqa: E402


def make_session(cpus: str = "*") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("vayumark")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    local_scratch(spark)
    return spark


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    os.environ.setdefault("TZ", "UTC")
    return make_session()
