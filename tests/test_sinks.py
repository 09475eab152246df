from __future__ import annotations

import glob
import tempfile
from datetime import timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lossmill.sinks import (
    append_ledger,
    last_operations,
    reconcile,
    replace_outcomes,
    replace_period,
    replace_periods,
    scratch_path,
)
from lossmill.sinks.ledger import Entry
from lossmill.sinks.tables import CLEAN, QUARANTINED, read_outcome
from lossmill.sources import read_table
from tests.conftest import plan, rows

SCHEMA = StructType([StructField("v", StringType()), StructField("period", StringType())])


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def stored(spark, path):
    return sorted(rows(read_table(spark, path, SCHEMA)))


@pytest.fixture
def table(spark, folder):
    path = f"{folder}/t"
    replace_periods(frame(spark, ("a", "2019S1"), ("b", "2019S2"), ("c", "2020S1")), path,
                    ["2019S1", "2019S2", "2020S1"])
    return path


def test_first_write_creates_the_table(spark, table):
    assert stored(spark, table) == [("a", "2019S1"), ("b", "2019S2"), ("c", "2020S1")]
    assert len(glob.glob(f"{table}/period=*")) == 3


def test_replacing_leaves_other_periods(spark, table):
    assert replace_period(frame(spark, ("x", "2019S2"), ("y", "2019S2")), table, "2019S2") == 2
    assert stored(spark, table) == [
        ("a", "2019S1"), ("c", "2020S1"), ("x", "2019S2"), ("y", "2019S2"),
    ]


def test_running_twice_changes_nothing(spark, table):
    before = stored(spark, table)
    replace_period(frame(spark, ("b", "2019S2")), table, "2019S2")
    assert stored(spark, table) == before


def test_period_without_rows_ends_up_empty(spark, table):
    assert replace_period(frame(spark), table, "2019S2") == 0
    assert stored(spark, table) == [("a", "2019S1"), ("c", "2020S1")]
    replace_periods(frame(spark, ("n", "2020S1")), table, ["2019S1", "2020S1"])
    assert stored(spark, table) == [("n", "2020S1")]


def test_empty_first_write_is_readable(spark, folder):
    replace_period(frame(spark), f"{folder}/t", "2019S1")
    assert stored(spark, f"{folder}/t") == []


@pytest.mark.parametrize("foreign", ["2020S1", None])
def test_foreign_rows_fail_and_nothing_is_lost(spark, table, foreign):
    before = stored(spark, table)
    with pytest.raises(Exception, match="row outside the replaced periods"):
        replace_period(frame(spark, ("x", "2019S2"), ("y", foreign)), table, "2019S2")
    assert stored(spark, table) == before


def test_failing_job_keeps_the_old_rows(spark, table):
    before = stored(spark, table)
    bad = frame(spark, ("x", "2019S2")).withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        replace_period(bad, table, "2019S2")
    assert stored(spark, table) == before


def test_own_rows_can_be_rewritten_from_a_period_scan(spark, table):
    """The period test must not reach rows that the scan leaves out."""
    one = read_table(spark, table, SCHEMA).where("period = '2019S1'")
    other = f"{table}-copy"
    assert replace_period(one, other, "2019S1") == 1
    assert stored(spark, other) == [("a", "2019S1")]


@pytest.mark.parametrize("bad", [[], ["2019/S1"], [""], ["../x"]])
def test_bad_period_names(spark, folder, bad):
    with pytest.raises(ValueError):
        replace_periods(frame(spark), f"{folder}/t", bad)


def test_rebalance_writes_one_file_per_small_period(spark, folder):
    data = frame(spark, *[(str(i), f"p{i % 3}") for i in range(300)]).repartition(4)
    for rebalance, most in ((True, 3), (False, 12)):
        path = f"{folder}/{rebalance}"
        assert replace_periods(data, path, ["p0", "p1", "p2"], rebalance=rebalance) == 300
        assert len(glob.glob(f"{path}/period=*/part-*")) <= most
        assert len(stored(spark, path)) == 300


def _lose_first_attempt(batches):
    """Hand on every batch, then fail the first attempt of one task."""
    yield from batches
    context = TaskContext.get()
    if context.partitionId() == 1 and context.attemptNumber() == 0:
        raise RuntimeError("lost")


@pytest.mark.parametrize("rebalance", [False, True])
def test_a_repeated_task_neither_doubles_nor_drops_rows(spark, folder, rebalance):
    data = spark.range(0, 1000, 1, 4).select(
        F.col("id").cast("string").alias("v"), F.concat(F.lit("p"), F.col("id") % 2).alias("period")
    )
    flaky = data.mapInArrow(_lose_first_attempt, SCHEMA)
    path = f"{folder}/t"
    assert replace_periods(flaky, path, ["p0", "p1", "p2"], rebalance=rebalance) == 1000
    assert len(set(stored(spark, path))) == len(stored(spark, path)) == 1000


PERIODS = ("p1", "p2", "p3")
STEP = st.tuples(
    st.sets(st.sampled_from(PERIODS), min_size=1),
    st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from(PERIODS)), max_size=6),
    st.booleans(),
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(steps=st.lists(STEP, min_size=1, max_size=4))
def test_any_sequence_of_replacements(spark, steps):
    """Against a plain dictionary of periods."""
    path, model = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/t", {}
    for wanted, data, rebalance in steps:
        kept = [(v, p) for v, p in data if p in wanted]
        assert replace_periods(frame(spark, *kept), path, wanted, rebalance) == len(kept)
        model |= {p: [row for row in kept if row[1] == p] for p in wanted}
    assert stored(spark, path) == sorted(row for kept in model.values() for row in kept)


def tagged(spark, *data):
    return spark.createDataFrame(list(data), "v string, period string, failure_reason string")


def outcomes(spark, path, periods):
    with_reason = StructType(SCHEMA.fields + [StructField("failure_reason", StringType())])
    return tuple(
        sorted(r.v for r in read_outcome(spark, path, schema, outcome, periods).collect())
        for outcome, schema in ((CLEAN, SCHEMA), (QUARANTINED, with_reason))
    )


def test_outcomes_are_split_and_replaced(spark, folder):
    path, both = f"{folder}/t", ["p1", "p2"]
    first = tagged(spark, ("a", "p1", None), ("b", "p1", "bad"), ("c", "p2", "bad"))
    assert replace_outcomes(first, path, both) == 3
    assert outcomes(spark, path, both) == (["a"], ["b", "c"])
    corrected = tagged(spark, ("a", "p1", None), ("b", "p1", None))
    replace_outcomes(corrected, path, ["p1"])
    assert outcomes(spark, path, both) == (["a", "b"], ["c"]), "old failures of p1 are gone"
    assert outcomes(spark, path, ["p1"]) == (["a", "b"], [])


def test_outcomes_without_any_failure(spark, folder):
    replace_outcomes(tagged(spark, ("a", "p1", None)), f"{folder}/t", ["p1"])
    assert outcomes(spark, f"{folder}/t", ["p1"]) == (["a"], [])


def test_ledger_keeps_every_run_newest_first(spark, folder, run_ts):
    path = f"{folder}/ledger"
    append_ledger(spark, path, [Entry("t", "p1", "replace", 1, run_ts)])
    later = run_ts + timedelta(days=1)
    second = [Entry("t", "p1", "replace", 2, later), Entry("u", "p1", "replace", 3, later)]
    append_ledger(spark, path, second)
    assert [(r.table_name, r.row_count) for r in last_operations(spark, path, 2).collect()] == [
        ("t", 2), ("u", 3),
    ]
    assert [r.row_count for r in last_operations(spark, path, 5, "t").collect()] == [2, 1]


def test_reconcile_reads_no_columns(spark, table):
    sent = frame(spark, ("a", "2019S1"))
    counts = reconcile({"sent": sent, "stored": read_table(spark, table, SCHEMA)})
    assert "ReadSchema: struct<>" in plan(counts)
    assert sorted(rows(counts)) == [
        ("sent", "2019S1", 1), ("stored", "2019S1", 1), ("stored", "2019S2", 1),
        ("stored", "2020S1", 1),
    ]


class Session:
    def __init__(self, **conf):
        self.conf = self
        self._values = conf

    def get(self, key, default=None):
        return self._values.get(key.replace(".", "_"), default)


def test_scratch_path_is_shared_where_the_cluster_names_one():
    path = scratch_path(Session(spark_checkpoint_dir="/shared/x/", spark_master="yarn"), "t")
    assert path.startswith("/shared/x/t-")
    local = scratch_path(Session(spark_master="local[2]"), "t")
    assert local != scratch_path(Session(spark_master="local[2]"), "t")
    with pytest.raises(ValueError, match="checkpoint"):
        scratch_path(Session(spark_master="yarn"), "t")
