"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from lossmill.plans.catalog import QUERIES
from lossmill.plans.oracles import ORACLES
from lossmill.sources.star import FAULT_CLAIMS, FAULT_PREMIUMS, Star
from tests.conftest import plan

SPARK_TO_SQL = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def sql(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def ordered(data):
    return sorted(data, key=lambda row: [(v is None, str(v)) for v in row])


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert len(NAMES) == 57


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, sql, sf_dir, name):
    df = contract.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    relation = sql.sql(contract.oracle_sql()[name])
    assert dict(zip(relation.columns, map(str, relation.types))) == {
        f.name: SPARK_TO_SQL[f.dataType.simpleString()] for f in df.schema
    }
    text = f"select {', '.join(columns)} from ({contract.oracle_sql()[name]})"
    expected = sql.sql(text).fetchall()
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert len(got) > 0
    assert ordered(got) == ordered(expected)


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 354


@pytest.mark.parametrize("name", ["gold_by_region", "dq_report", "column_profile", "silver_join"])
def test_plans_stay_in_the_jvm_and_read_only_what_they_use(spark, sf_dir, name):
    text = plan(contract.queries()[name](spark, sf_dir))
    assert "Python" not in text and "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "l_orderkey:bigint,l_extendedprice:double,l_discount:double>" in text
    assert "c_name" not in text and "o_orderpriority" not in text


def test_lines_are_summed_before_their_shuffle(spark, sf_dir):
    text = plan(contract.queries()["silver_typed_claim"](spark, sf_dir))
    exchange = text.index("Exchange hashpartitioning(l_orderkey")
    assert "partial_sum" in text[exchange : exchange + 400]


@pytest.mark.parametrize(
    "name", ["gold_by_region", "gold_by_coverage", "gold_alerts", "top_regions", "top_segments", "top_alerts"]
)
def test_ranked_results_come_highest_first(spark, sf_dir, name):
    got = [r.loss_ratio for r in QUERIES[name](spark, sf_dir).collect()]
    assert got == sorted(got, key=lambda x: (x is None, -(x or 0)))


def test_all_given_rows_are_kept_beside_the_added_ones(spark, sf_dir):
    with_faults, plain = Star(spark, sf_dir), Star(spark, sf_dir, faults=False)
    n_periods = len(plain.periods)
    for name, added in (("premium", len(FAULT_PREMIUMS)), ("claim", len(FAULT_CLAIMS))):
        given, all_rows = getattr(plain, name), getattr(with_faults, name)
        assert all_rows.count() == given.count() + added * n_periods
        assert given.exceptAll(all_rows).count() == 0
    assert plain.regions.count() == 25
