"""A third of all orders on one customer and a third of all lines on one order."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from lossmill.sources.star import Star
from tests.conftest import SMALL_SKEW, plan
from tests.test_catalog import ordered

TABLES = ("customer", "nation", "orders", "lineitem")


@pytest.fixture(scope="module")
def skewed_dir(spark, sf_dir, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("skewed"))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    third = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(3)) == 0
    changed = {
        "orders": orders.withColumn(
            "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(F.col("o_custkey"))
        ),
        "lineitem": lines.withColumn(
            "l_orderkey", F.when(third, 1).otherwise(F.col("l_orderkey"))
        ),
    }
    for name in TABLES:
        df = changed.get(name, spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        df.repartition(8).write.parquet(f"{base}/{name}.parquet")
    return base


@pytest.mark.parametrize("name", ["silver_join", "gold_by_region", "gold_summary", "dq_report"])
def test_results_hold_under_skew(spark, session_conf, skewed_dir, name):
    session_conf(SMALL_SKEW)
    connection = duckdb.connect()
    for table in TABLES:
        files = os.path.join(skewed_dir, f"{table}.parquet", "*.parquet")
        connection.execute(f"create view {table} as select * from '{files}'")
    df = contract.queries()[name](spark, skewed_dir)
    columns = sorted(df.columns)
    expected = connection.sql(
        f"select {', '.join(columns)} from ({contract.oracle_sql()[name]})"
    ).fetchall()
    assert ordered(tuple(r) for r in df.select(*columns).collect()) == ordered(expected)


def test_hot_customer_is_split(spark, session_conf, skewed_dir):
    session_conf(SMALL_SKEW | {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
                               "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB"})
    assert "SortMergeJoin(skew=true)" in plan(Star(spark, skewed_dir).premium)
