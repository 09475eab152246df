from __future__ import annotations

import glob
import os
from dataclasses import replace
from datetime import timedelta

import pytest

from lossmill import schemas
from lossmill.operators import marts, quality, silver
from lossmill.plans import medallion
from lossmill.plans.medallion import Settings
from lossmill.sinks import last_operations
from lossmill.sinks.tables import CLEAN, QUARANTINED
from lossmill.sources import read_regions, read_table
from tests.conftest import plan, rows
from tests.fixtures import PERIOD, SAMPLE_CLAIM, SAMPLE_PREMIUM, write_sample

GOLD = {
    "gold/by_region": schemas.GOLD_BY_REGION,
    "gold/by_coverage": schemas.GOLD_BY_COVERAGE,
    "gold/summary": schemas.GOLD_SUMMARY,
    "gold/alerts": schemas.GOLD_ALERTS,
}


def run_sample(spark, folder, run_ts, period=PERIOD, **texts):
    paths = write_sample(folder)
    for name, text in texts.items():
        with open(paths[name], "w", encoding="ISO-8859-1") as f:
            f.write(text)
    run = Settings(f"{folder}/layers", (period,), run_ts=run_ts)
    regions = read_regions(spark, paths["region"])
    medallion.run_all(spark, run, paths["premium"], paths["claim"], regions)
    return run


def gold(spark, run):
    return {
        name: sorted(rows(read_table(spark, run.path(name), schema).drop("processed_at")), key=str)
        for name, schema in GOLD.items()
    }


def test_sample_from_files_to_marts(spark, folder, run_ts):
    run = run_sample(spark, folder, run_ts)
    clean = medallion.read_silver(spark, run, CLEAN)
    assert clean.count() == 9 and clean.columns == schemas.SILVER.names
    assert medallion.read_silver(spark, run, QUARANTINED).count() == 0
    found = gold(spark, run)
    assert {k: len(v) for k, v in found.items()} == {
        "gold/by_region": 3, "gold/by_coverage": 3, "gold/summary": 1, "gold/alerts": 2,
    }
    summary = read_table(spark, run.path("gold/summary"), schemas.GOLD_SUMMARY).first()
    assert summary.portfolio_loss_ratio == 0.7284 and summary.loss_making_segments == 2
    assert summary.processed_at is not None
    operations = last_operations(spark, run.path("ledger"), 20).collect()
    tables = {r.table_name: r.row_count for r in operations}
    assert tables == {
        "bronze/premium": 9, "bronze/claim": 9, "silver/clean": 9, "silver/quarantine": 0,
        "gold/by_region": 3, "gold/by_coverage": 3, "gold/summary": 1, "gold/alerts": 2,
    }


def test_second_run_changes_only_the_ledger(spark, folder, run_ts):
    first = run_sample(spark, folder, run_ts)
    before = gold(spark, first)
    second = run_sample(spark, folder, run_ts + timedelta(hours=1))
    assert gold(spark, second) == before
    assert last_operations(spark, second.path("ledger"), 99).count() == 16


def test_other_periods_stay_and_corrections_empty_the_quarantine(spark, folder, run_ts):
    run_sample(spark, folder, run_ts, period="2019S1")
    broken = SAMPLE_PREMIUM.replace("9876543,210987", "n/d")
    bad = run_sample(spark, folder, run_ts, premium=broken)
    reasons = medallion.read_silver(spark, bad, QUARANTINED).collect()
    assert [(r.region_code, r.coverage, r.failure_reason) for r in reasons] == [
        ("38", "APP", "premium_null")
    ]
    fixed = run_sample(spark, folder, run_ts)
    assert medallion.read_silver(spark, fixed, QUARANTINED).count() == 0
    summaries = read_table(spark, fixed.path("gold/summary"), schemas.GOLD_SUMMARY).collect()
    assert {r.period: r.segments for r in summaries} == {"2019S1": 9, PERIOD: 9}


@pytest.mark.parametrize("split", [False, True])
def test_repeated_claims_fan_out(spark, folder, run_ts, split):
    line = "38;DF - Brasília;RCDM;24567;75904085\n"
    run = run_sample(spark, folder, run_ts, claim=SAMPLE_CLAIM + line)
    again = replace(run, repeated_claim_keys=split)
    medallion.refine(spark, again, read_regions(spark, f"{folder}/region.csv"))
    assert medallion.read_silver(spark, run, CLEAN).count() == 10


def test_optional_rules_quarantine_bad_claims(spark, folder, run_ts):
    line = "38;DF - Brasília;RCDM;24567;75904085\n"
    run = run_sample(spark, folder, run_ts, claim=SAMPLE_CLAIM.replace(";412300", ";abc") + line)
    assert medallion.read_silver(spark, run, QUARANTINED).count() == 0
    rules = (*quality.RULES, quality.CLAIM_MALFORMED, quality.CLAIM_REPEATED)
    strict = Settings(run.base, run.periods, rules=rules, run_ts=run_ts)
    medallion.refine(spark, strict, read_regions(spark, f"{folder}/region.csv"))
    found = medallion.read_silver(spark, strict, QUARANTINED).collect()
    assert sorted((r.region_code, r.coverage, r.failure_reason) for r in found) == [
        ("38", "APP", "claim_malformed"),
        ("38", "RCDM", "claim_repeated"),
        ("38", "RCDM", "claim_repeated"),
    ]
    assert medallion.read_silver(spark, strict, CLEAN).count() == 7


def test_compact_writes_the_same_rows(spark, folder, run_ts):
    run = run_sample(spark, folder, run_ts)
    before = sorted(rows(medallion.read_silver(spark, run, CLEAN)))
    paths = write_sample(folder)
    compact = Settings(run.base, run.periods, compact=True, run_ts=run_ts)
    medallion.refine(spark, compact, read_regions(spark, paths["region"]))
    assert sorted(rows(medallion.read_silver(spark, run, CLEAN))) == before
    assert len(glob.glob(f"{run.path('silver')}/outcome=clean/period=*/part-*")) == 1


def test_period_directories_in_one_run(spark, folder, run_ts):
    for period in ("2019S1", "2019S2"):
        for name, text in (("premium", SAMPLE_PREMIUM), ("claim", SAMPLE_CLAIM)):
            os.makedirs(f"{folder}/{name}/period={period}")
            with open(f"{folder}/{name}/period={period}/a.csv", "w", encoding="ISO-8859-1") as f:
                f.write(text)
    regions = read_regions(spark, write_sample(folder)["region"])
    run = Settings(f"{folder}/layers", ("2019S1", "2019S2"), run_ts=run_ts)
    medallion.run_all(
        spark, run, f"{folder}/premium", f"{folder}/claim", regions, period_dirs=True
    )
    mart = read_table(spark, run.path("gold/by_region"), schemas.GOLD_BY_REGION)
    assert dict(mart.groupBy("period").count().collect()) == {"2019S1": 3, "2019S2": 3}
    layers = medallion.stored_layers(spark, run)
    assert {k: v.count() for k, v in layers.items()} == {
        "bronze_premium": 18, "bronze_claim": 18, "silver_clean": 18, "silver_quarantine": 0,
    }


def test_empty_source_stops_the_run(spark, folder, run_ts):
    with pytest.raises(ValueError, match="at least 1 row"):
        run_sample(spark, folder, run_ts, claim=SAMPLE_CLAIM.splitlines()[0] + "\n")
    assert not os.path.exists(f"{folder}/layers")


def test_several_periods_need_period_directories(spark, folder, run_ts):
    run = Settings(folder, ("a", "b"), run_ts=run_ts)
    with pytest.raises(ValueError, match="exactly one period"):
        medallion.ingest(spark, run, "x", "y")


def test_thresholds_reach_the_marts(spark, folder, run_ts):
    run = run_sample(spark, folder, run_ts)
    strict = Settings(run.base, run.periods, loss_threshold=0.7, watch_threshold=0.1, run_ts=run_ts)
    medallion.publish(spark, strict)
    mart = read_table(spark, strict.path("gold/by_region"), schemas.GOLD_BY_REGION)
    assert mart.columns == schemas.GOLD_BY_REGION.names
    assert {r.region_code: r.risk_tier for r in mart.collect()} == {
        "01": "WATCH", "04": "HIGH", "38": "HIGH",
    }
    assert len(gold(spark, strict)["gold/alerts"]) == 5


def test_stored_scans_are_pruned_and_pushed_down(spark, folder, run_ts):
    run = run_sample(spark, folder, run_ts)
    clean = medallion.read_silver(spark, run, CLEAN)
    alerts = plan(marts.alerts(clean))
    assert "GreaterThan(loss_ratio,1.0)" in alerts
    scan = alerts[alerts.index("PartitionFilters") :]
    assert "period" in scan[: scan.index("PushedFilters")]
    assert "outcome=clean/period=" in alerts[alerts.index("Location") :]
    assert "period" in scan[: scan.index("PushedFilters")]
    by_region = plan(marts.by_region(clean))
    read = by_region[by_region.index("ReadSchema") :].splitlines()[0]
    assert "avg_insured" not in read and "processed_at" not in read
    bronze = medallion.stored_layers(spark, run)["bronze_premium"]
    joined = plan(silver.type_premium(bronze).select("premium"))
    assert "ReadSchema: struct<premium:string>" in joined


def test_refine_does_not_shuffle_premium_rows(spark, folder, run_ts):
    """Claims and regions within Spark's size threshold are broadcast."""
    run = run_sample(spark, folder, run_ts)
    layers = medallion.stored_layers(spark, run)
    tagged = medallion.tagged_rows(
        silver.type_premium(layers["bronze_premium"]),
        silver.type_claim(layers["bronze_claim"]),
        read_regions(spark, f"{folder}/region.csv"),
    )
    text = plan(tagged)
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") >= 2


def write_periods(folder, name, texts):
    for period, text in texts.items():
        path = f"{folder}/{name}/period={period}"
        os.makedirs(path, exist_ok=True)
        with open(f"{path}/a.csv", "w", encoding="ISO-8859-1") as f:
            f.write(text)


HEADER = SAMPLE_PREMIUM.splitlines()[0] + "\n"


@pytest.mark.parametrize(
    "premium, claim",
    [
        ({"2019S1": SAMPLE_PREMIUM, "2019S2": HEADER}, {"2019S1": SAMPLE_CLAIM, "2019S2": SAMPLE_CLAIM}),
        ({"2019S1": SAMPLE_PREMIUM, "2019S2": SAMPLE_PREMIUM}, {"2019S1": SAMPLE_CLAIM}),
        ({"2019S1": SAMPLE_PREMIUM}, {"2019S1": SAMPLE_CLAIM}),
    ],
)
def test_every_period_needs_rows_in_both_sources(spark, folder, run_ts, premium, claim):
    good = {p: SAMPLE_PREMIUM for p in ("2019S1", "2019S2")}
    write_periods(folder, "ok-premium", good)
    write_periods(folder, "ok-claim", {p: SAMPLE_CLAIM for p in good})
    run = Settings(f"{folder}/layers", ("2019S1", "2019S2"), run_ts=run_ts)
    regions = read_regions(spark, write_sample(folder)["region"])
    medallion.run_all(spark, run, f"{folder}/ok-premium", f"{folder}/ok-claim", regions, True)
    before = gold(spark, run)
    write_periods(folder, "premium", premium)
    write_periods(folder, "claim", claim)
    with pytest.raises(ValueError, match="2019S2"):
        medallion.ingest(spark, run, f"{folder}/premium", f"{folder}/claim", True)
    layers = medallion.stored_layers(spark, run)
    assert layers["bronze_premium"].count() == layers["bronze_claim"].count() == 18
    assert gold(spark, run) == before
    cleared = replace(run, may_be_empty=("2019S2",))
    medallion.run_all(spark, cleared, f"{folder}/premium", f"{folder}/claim", regions, True)
    assert medallion.stored_layers(spark, run)["bronze_premium"].where("period = '2019S1'").count() == 9


def test_rows_without_a_period_are_quarantined(spark, folder, run_ts):
    none = "__HIVE_DEFAULT_PARTITION__"
    write_periods(folder, "premium", {"2019S2": SAMPLE_PREMIUM, none: SAMPLE_PREMIUM})
    write_periods(folder, "claim", {"2019S2": SAMPLE_CLAIM})
    regions = read_regions(spark, write_sample(folder)["region"])
    rules = (quality.PERIOD_NULL, *quality.RULES)
    run = Settings(f"{folder}/layers", ("2019S2",), rules=rules, run_ts=run_ts)
    for _ in range(2):
        medallion.run_all(spark, run, f"{folder}/premium", f"{folder}/claim", regions, True)
        failed = medallion.read_silver(spark, run, QUARANTINED)
        assert {tuple(r) for r in failed.select("period", "failure_reason").collect()} == {
            (None, "period_null")
        }
        assert failed.count() == 9 and medallion.read_silver(spark, run, CLEAN).count() == 9
    plain = replace(run, rules=quality.RULES)
    medallion.run_all(spark, plain, f"{folder}/premium", f"{folder}/claim", regions, True)
    assert medallion.read_silver(spark, plain, QUARANTINED).count() == 0


def test_marts_shuffle_only_their_own_keys(spark, folder, run_ts):
    """No exchange by segment and nothing cached on the way from silver to a mart."""
    run = run_sample(spark, folder, run_ts)
    clean = medallion.read_silver(spark, run, CLEAN)
    for mart in (marts.by_region(clean), marts.by_coverage(clean), marts.summary(clean)):
        text = plan(mart).split("Initial Plan")[0]
        assert "InMemoryTableScan" not in text and text.count("Exchange hashpartitioning") == 1
        keys = text[text.index("Exchange hashpartitioning") :].split(")")[0]
        assert not ("region_code" in keys and "coverage" in keys)
        assert "partial_sum" in text


def test_quality_reports_from_the_stored_table(spark, folder, run_ts):
    broken = SAMPLE_PREMIUM.replace("9876543,210987", "n/d").replace("35678901,234567", "0")
    run = run_sample(spark, folder, run_ts, premium=broken)
    tagged = medallion.read_tagged(spark, run)
    report = quality.quality_report(tagged, ["period"]).first()
    assert tuple(report) == (PERIOD, 9, 7, 2, 77.8)
    assert rows(quality.quarantine_breakdown(tagged)) == [
        ("premium_not_positive", 1), ("premium_null", 1),
    ]
