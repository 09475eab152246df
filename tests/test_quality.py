from __future__ import annotations

import pytest

from lossmill.operators import quality, silver
from lossmill.plans.medallion import tagged_rows
from tests.conftest import rows
from tests.fixtures import edge_claim, edge_premium, edge_regions, keyed

EXPECTED = {
    "01 APP": None,
    "02 APP": None,
    "- APP": "region_null",
    "01 X1": "premium_null",
    "01 X2": "premium_null",
    "01 X3": "premium_not_positive",
    "01 X4": "claim_negative",
    "99 APP": "region_unknown",
    "01 X5": None,
    "01 X6": None,
    "01 X7": None,
    "01 X8": None,
    "01 X9": None,
}


@pytest.fixture
def tagged(spark):
    return tagged_rows(
        silver.type_premium(edge_premium(spark)),
        silver.type_claim(edge_claim(spark)),
        edge_regions(spark),
    )


def test_first_failing_rule_names_the_reason(tagged):
    got = keyed(tagged, "failure_reason")
    assert {k: v[0][0] for k, v in got.items()} == EXPECTED


def test_rule_order_decides(spark):
    df = spark.createDataFrame(
        [(None, None, -1.0, None), ("1", None, -1.0, None), ("1", 0.0, -1.0, None),
         ("1", 1.0, -1.0, None), ("1", 1.0, 1.0, None), ("1", 1.0, None, "n")],
        "region_code string, premium double, claim_amount double, region_name string",
    )
    reasons = [r.failure_reason for r in quality.tag(df).collect()]
    assert reasons == [rule.code for rule in quality.RULES] + [None]


def test_no_rules_means_all_clean(spark):
    assert rows(quality.tag(spark.range(1), ())) == [(0, None)]


def test_optional_rules(spark):
    claim = silver.type_claim(edge_claim(spark), keep_malformed=True)
    joined = silver.join_claims(silver.type_premium(edge_premium(spark, period=None)), claim)
    named = silver.enrich(joined, edge_regions(spark))
    tagged = quality.tag(named, (quality.PERIOD_NULL,))
    assert {r.failure_reason for r in tagged.collect()} == {"period_null"}
    joined = silver.join_claims(silver.type_premium(edge_premium(spark)), claim)
    tagged = quality.tag(joined, (quality.CLAIM_MALFORMED,))
    failed = {r.coverage for r in tagged.where("failure_reason is not null").collect()}
    assert failed == {"X5", "X6"}


def test_nan_premium_passes_as_clean(spark):
    df = spark.createDataFrame([(float("nan"),)], "premium double")
    rule = quality.RULES[2]
    assert quality.tag(df, (rule,)).first().failure_reason is None


def test_alert_flag(tagged):
    got = keyed(tagged, "high_ratio_alert")
    assert got["01 X7"] == [(True,)]
    assert got["01 X8"] == [(False,)]
    assert got["01 X1"] == [(False,)], "a null ratio is no alert"
    assert tagged.count() == 14, "alerts keep their rows"


def test_alert_threshold_is_a_parameter(tagged):
    strict = quality.flag(tagged.drop("high_ratio_alert"), [quality.high_ratio(1.5)])
    assert keyed(strict, "high_ratio_alert")["01 X8"] == [(True,)]


def test_split_is_whole(tagged):
    clean, quarantine = quality.split(tagged)
    assert clean.count() == 8 and quarantine.count() == 6
    assert "failure_reason" not in clean.columns
    assert {r.failure_reason for r in quarantine.collect()} == {r.code for r in quality.RULES}


def test_report(tagged):
    assert quality.quality_report(tagged).first().asDict() == {
        "total_rows": 14, "clean_rows": 8, "quarantined_rows": 6, "pass_rate_pct": 57.1,
    }
    empty = quality.quality_report(tagged.where("false")).first()
    assert tuple(empty) == (0, 0, 0, 0.0)
    by_coverage = quality.quality_report(tagged, ["coverage"])
    assert by_coverage.where("coverage = 'APP'").first()[1:] == (4, 2, 2, 50.0)


def test_breakdown(tagged):
    got = rows(quality.quarantine_breakdown(tagged))
    assert got[0] == ("premium_null", 2)
    assert [r[0] for r in got[1:]] == sorted(r[0] for r in got[1:])
    assert sum(n for _, n in got) == 6
