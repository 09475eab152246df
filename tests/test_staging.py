"""Writes that take effect only when they have what they should."""

from __future__ import annotations

import glob
import os
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import pytest

from lossmill import schemas
from lossmill.plans import medallion
from lossmill.plans.medallion import Settings
from lossmill.sinks import append_ledger, last_operations, ledger
from lossmill.sinks.files import Files
from lossmill.sinks.ledger import Conflict, Entry
from lossmill.sinks.tables import CLEAN, stage_periods
from lossmill.sources import read_regions, read_table
from tests.conftest import rows
from tests.fixtures import PERIOD, SAMPLE_CLAIM, SAMPLE_PREMIUM, write_sample
from tests.test_medallion import gold, run_sample, write_periods
from tests.test_sinks import SCHEMA, frame, stored


def files_below(folder):
    return sorted(p for p in glob.glob(f"{folder}/**", recursive=True, include_hidden=True) if os.path.isfile(p))


class Plans:
    """Physical plans of the queries that ran inside of a ``with`` block."""

    def __init__(self, spark):
        self._store = spark._jsparkSession.sharedState().statusStore()

    def __enter__(self):
        self._before = self._store.executionsList().size()
        return self

    def __exit__(self, *_):
        done = self._store.executionsList()
        self.texts = [
            done.apply(k).physicalPlanDescription() for k in range(self._before, done.size())
        ]

    def count(self, *parts):
        return sum(all(p in text for p in parts) for text in self.texts)


def test_staged_rows_are_not_part_of_the_table(spark, folder):
    path = f"{folder}/deep/t"
    staged = stage_periods(frame(spark, ("a", "p1"), ("b", "p1")), path, ["p1", "p2"])
    assert stored(spark, path) == []
    assert staged.counts() == {("p1",): 2, ("p2",): 0}
    staged.discard()
    assert not os.path.exists(f"{folder}/deep")
    stage_periods(frame(spark, ("a", "p1")), path, ["p1", "p2"]).swap()
    later = stage_periods(frame(spark, ("c", "p2")), path, ["p1", "p2"])
    assert stored(spark, path) == [("a", "p1")]
    assert later.swap() == 1
    assert stored(spark, path) == [("c", "p2")]
    assert [n for n in os.listdir(path) if n.startswith(".")] == []


def test_a_table_can_be_rewritten_from_itself(spark, folder):
    path = f"{folder}/t"
    stage_periods(frame(spark, ("a", "p1"), ("b", "p2")), path, ["p1", "p2"]).swap()
    again = read_table(spark, path, SCHEMA)
    stage_periods(again.unionByName(frame(spark, ("c", "p1"))), path, ["p1", "p2"]).swap()
    assert stored(spark, path) == [("a", "p1"), ("b", "p2"), ("c", "p1")]


def test_each_source_is_scanned_once(spark, folder, run_ts):
    paths = write_sample(folder)
    run = Settings(f"{folder}/layers", (PERIOD,), run_ts=run_ts)
    with Plans(spark) as plans:
        medallion.ingest(spark, run, paths["premium"], paths["claim"])
    assert plans.count("Scan csv") == 2


def test_silver_is_scanned_once_for_three_marts(spark, folder, run_ts):
    run = run_sample(spark, folder, run_ts)
    before = gold(spark, run)
    with Plans(spark) as plans:
        medallion.publish(spark, run)
    read = [t for t in plans.texts if "outcome=clean" in t]
    assert len(read) == 2
    assert sum("Expand" in t and "partial_sum" in t for t in read) == 1
    assert sum("GreaterThan(loss_ratio" in t for t in read) == 1
    assert gold(spark, run) == before
    assert not os.path.exists(f"{run.base}/gold/totals")


def test_a_failed_guard_changes_no_file(spark, folder, run_ts):
    run = run_sample(spark, folder, run_ts)
    before = files_below(run.base)
    header = SAMPLE_CLAIM.splitlines()[0] + "\n"
    with pytest.raises(ValueError, match="bronze/claim: expected at least 1 row"):
        run_sample(spark, folder, run_ts, claim=header)
    assert files_below(run.base) == before
    missing = f"{folder}/nowhere.csv"
    with pytest.raises(Exception, match="nowhere"):
        medallion.ingest(spark, run, f"{folder}/premium.csv", missing)
    assert files_below(run.base) == before


def broken_sample(folder):
    write_sample(folder)
    premium = SAMPLE_PREMIUM.replace(";75432,123456789", "") + "99;only two\n"
    claim = SAMPLE_CLAIM.replace("143200", "143200;0;0")
    return premium, claim


def test_malformed_lines_are_kept_apart(spark, folder, run_ts):
    premium, claim = broken_sample(folder)
    for name, text in (("premium", premium), ("claim", claim)):
        with open(f"{folder}/{name}.csv", "w", encoding="ISO-8859-1") as f:
            f.write(text)
    regions = read_regions(spark, f"{folder}/region.csv")
    run = Settings(f"{folder}/layers", (PERIOD,), run_ts=run_ts, quarantine_lines=True)
    for _ in range(2):
        medallion.run_all(spark, run, f"{folder}/premium.csv", f"{folder}/claim.csv", regions)
        lines = medallion.read_lines(spark, run, "premium").collect()
        assert sorted(r.corrupt_line for r in lines) == [
            "04;SC - Oeste;APP;98234,123456789;4521890,654321", "99;only two",
        ]
        assert {(r.region_code, r.period) for r in lines} == {("04", PERIOD), ("99", PERIOD)}
        (line,) = medallion.read_lines(spark, run, "claim").collect()
        assert line.corrupt_line == "04;SC - Oeste;APP;12;143200;0;0"
    layers = {k: v.count() for k, v in medallion.stored_layers(spark, run).items()}
    assert layers == {
        "bronze_premium": 8, "bronze_claim": 8, "bronze_premium_lines": 2, "bronze_claim_lines": 1,
        "silver_clean": 8, "silver_quarantine": 0,
    }
    clean = medallion.read_silver(spark, run, CLEAN).where("region_code = '04'")
    assert {r.coverage for r in clean.collect()} == {"CASCO", "RCDM"}
    entered = last_operations(spark, run.path("ledger"), 99).where("version = 2").collect()
    assert {r.table_name: r.row_count for r in entered}["bronze/premium_lines"] == 2
    # Without the option lines are padded and cut, and those of the earlier run go.
    plain = replace(run, quarantine_lines=False)
    medallion.ingest(spark, plain, f"{folder}/premium.csv", f"{folder}/claim.csv")
    assert medallion.stored_layers(spark, plain)["bronze_premium"].count() == 10
    assert medallion.read_lines(spark, run, "premium").count() == 0


def test_malformed_lines_do_not_count_for_the_guard(spark, folder, run_ts):
    texts = {"2019S1": SAMPLE_PREMIUM, "2019S2": SAMPLE_PREMIUM.splitlines()[0] + "\n01;x\n"}
    write_periods(folder, "premium", texts)
    write_periods(folder, "claim", dict.fromkeys(texts, SAMPLE_CLAIM))
    run = Settings(f"{folder}/layers", tuple(texts), run_ts=run_ts, quarantine_lines=True)
    with pytest.raises(ValueError, match="2019S2"):
        medallion.ingest(spark, run, f"{folder}/premium", f"{folder}/claim", True)
    assert not os.path.exists(run.base)
    medallion.ingest(
        spark, replace(run, quarantine_lines=False), f"{folder}/premium", f"{folder}/claim", True
    )


def test_versions_count_per_table(spark, folder, run_ts):
    path = f"{folder}/ledger"
    entries = [Entry("t", p, "replace", 1, run_ts) for p in ("p1", "p2")]
    append_ledger(spark, path, [*entries, Entry("u/v", "p1", "replace", 1, run_ts)])
    append_ledger(spark, path, entries[:1])
    found = rows(read_table(spark, path, schemas.LEDGER).select("table_name", "period", "version"))
    assert sorted(found) == [("t", "p1", 1), ("t", "p1", 2), ("t", "p2", 1), ("u/v", "p1", 1)]
    assert ledger.current_versions(spark, path, ["t", "u/v", "w"]) == {"t": 2, "u/v": 1, "w": 0}
    newest = last_operations(spark, path, 2, "t").collect()
    assert [(r.version, r.period) for r in newest] == [(2, "p1"), (1, "p2")]


def test_two_writers_never_take_one_version(spark, folder):
    path = f"{folder}/ledger"
    with ThreadPoolExecutor(8) as pool:
        taken = list(pool.map(lambda _: ledger.claim_version(spark, path, "t", ["p"]), range(24)))
    assert sorted(taken) == list(range(1, 25))


def test_a_writer_that_began_earlier_is_told(spark, folder, run_ts):
    path = f"{folder}/ledger"
    append_ledger(spark, path, [Entry("t", "p1", "replace", 1, run_ts)])
    with pytest.raises(Conflict, match="version 1"):
        ledger.claim_version(spark, path, "t", ["p1"], base=0)
    assert ledger.claim_version(spark, path, "t", ["p2"], base=0) == 2
    # Version 2 is claimed, but nothing is known of it yet.
    with pytest.raises(Conflict, match="version 2"):
        ledger.claim_version(spark, path, "t", ["p3"], base=1)


def test_a_conflict_leaves_the_tables_alone(spark, folder, run_ts, monkeypatch):
    run = run_sample(spark, folder, run_ts)
    before = gold(spark, run)
    known = medallion._base

    def overtaken(spark, run, names):
        found = known(spark, run, names)
        ledger.claim_version(spark, run.path("ledger"), "gold/summary", run.periods)
        return found

    monkeypatch.setattr(medallion, "_base", overtaken)
    strict = replace(run, loss_threshold=0.1)
    with pytest.raises(Conflict, match="gold/summary"):
        medallion.publish(spark, strict)
    assert gold(spark, run) == before
    assert not glob.glob(f"{run.base}/gold/*/.staging*")
    monkeypatch.undo()
    medallion.publish(spark, strict)
    assert len(gold(spark, run)["gold/alerts"]) > len(before["gold/alerts"])


def test_moving_what_is_not_there_is_an_error(spark, folder):
    files = Files(spark)
    with pytest.raises(Exception, match="none"):
        files.move(f"{folder}/none", f"{folder}/target")
    assert files.names(f"{folder}/none") == []
