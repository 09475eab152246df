from __future__ import annotations

import os
import tempfile
from datetime import datetime, timezone

import pytest
from pyspark.sql import SparkSession

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
RUN_TS = datetime(2020, 1, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4,3]")  # three attempts per task
        .appName("lossmill-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def session_conf(spark):
    """Set session options for one test."""
    changed = []

    def set_all(options):
        for key, value in options.items():
            changed.append((key, spark.conf.get(key, None)))
            spark.conf.set(key, value)

    yield set_all
    for key, before in reversed(changed):
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


@pytest.fixture
def folder():
    """A new folder per test; nothing is deleted."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def run_ts():
    return RUN_TS


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}
# Thresholds small enough for test data to count as skewed.
SMALL_SKEW = NO_BROADCAST | {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def rows(df):
    return [tuple(r) for r in df.collect()]


def plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
