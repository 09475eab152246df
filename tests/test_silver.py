from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lossmill.operators import silver
from tests.conftest import NO_BROADCAST, SMALL_SKEW, plan, rows
from tests.fixtures import PERIOD, edge_claim, edge_premium, edge_regions, keyed


@pytest.fixture
def typed(spark):
    return silver.type_premium(edge_premium(spark)), silver.type_claim(edge_claim(spark))


def test_typed_columns(typed):
    premium, claim = typed
    assert premium.columns == [
        "region_code", "premium_region_name", "coverage", "exposure", "premium", "avg_insured",
        "period", "premium_ingested_at",
    ]
    assert claim.columns == [
        "claim_region_code", "claim_coverage", "claim_count", "claim_amount", "claim_period",
        "claim_ingested_at",
    ]
    assert premium.schema["premium"].dataType.simpleString() == "double"
    assert claim.schema["claim_count"].dataType.simpleString() == "bigint"


def test_cast_columns(spark):
    df = spark.createDataFrame([("1,5", "2", "x")], "a string, b string, c string")
    cast = silver.cast_columns(df, decimals=["a"], longs=["b"])
    assert rows(cast) == [(1.5, 2, "x")] and cast.columns == ["a", "b", "c"]
    assert silver.cast_columns(df) is df


def test_join_edges(typed):
    got = keyed(silver.join_claims(*typed), "premium", "claim_count", "claim_amount", "loss_ratio")
    assert got == {
        "01 APP": [(100.5, 2, 50.25, 0.5)],
        "02 APP": [(100.0, 0, 0.0, 0.0)],
        "- APP": [(10.0, 0, 0.0, 0.0)],
        "01 X1": [(None, 0, 0.0, None)],
        "01 X2": [(None, 0, 0.0, None)],
        "01 X3": [(0.0, 0, 0.0, None)],
        "01 X4": [(10.0, 1, -5.0, -0.5)],
        "99 APP": [(10.0, 0, 0.0, 0.0)],
        "01 X5": [(10.0, 1, 0.0, 0.0)],
        "01 X6": [(10.0, 0, 5.0, 0.5)],
        "01 X7": [(10.0, 3, 25.0, 2.5)],
        "01 X8": [(10.0, 3, 20.0, 2.0)],
        "01 X9": got["01 X9"],
    }
    assert sorted(got["01 X9"]) == [(10.0, 1, 1.0, 0.1), (10.0, 2, 2.0, 0.2)]


def test_join_keeps_periods_apart(spark):
    premium = edge_premium(spark, period="2019S1").unionByName(edge_premium(spark, period="2019S2"))
    claim = edge_claim(spark, period="2019S2")
    joined = silver.join_claims(silver.type_premium(premium), silver.type_claim(claim))
    counts = dict(joined.groupBy("period").agg(F.sum("claim_count")).collect())
    assert counts == {"2019S1": 0, "2019S2": 2 + 1 + 1 + 3 + 3 + 1 + 2}


def test_both_join_forms_agree(typed):
    left = silver.join_claims(*typed)
    split = silver.join_claims(*typed, repeated_claim_keys=True)
    assert left.columns == split.columns
    assert sorted(map(str, rows(left))) == sorted(map(str, rows(split)))


def _sides(spark, premium_rows, claim_rows, hot_premium, hot_claim):
    """Premium and claims with unique keys, but for a third of the rows on the key ``hot``."""

    def region(is_hot):
        other = F.concat(F.lit("r"), F.col("id").cast("string"))
        return F.when(F.col("id") % 3 == 0, "hot").otherwise(other) if is_hot else F.when(
            F.col("id") == 0, "hot").otherwise(other)

    premium = spark.range(0, premium_rows, 1, 8).select(
        region(hot_premium).alias("region_code"), F.lit("c").alias("coverage"),
        F.lit("p").alias("period"), F.lit(2.0).alias("premium"),
        F.sha2(F.col("id").cast("string"), 512).alias("premium_region_name"),
    )
    claim = spark.range(0, claim_rows, 1, 8).select(
        region(hot_claim).alias("claim_region_code"), F.lit("c").alias("claim_coverage"),
        F.lit("p").alias("claim_period"), F.lit(1).cast("bigint").alias("claim_count"),
        F.rand(1).alias("claim_amount"), F.lit(None).cast("timestamp").alias("claim_ingested_at"),
    )
    return premium, claim


@pytest.mark.parametrize("repeated", [False, True])
def test_hot_keys_on_both_sides(spark, session_conf, repeated):
    session_conf(NO_BROADCAST)
    joined = silver.join_claims(*_sides(spark, 600, 90, True, True), repeated_claim_keys=repeated)
    assert "SortMergeJoin" in plan(joined)
    # 200 hot premium rows meet 30 hot claims; 60 of the 400 others meet their one claim.
    assert joined.count() == 200 * 30 + 400
    assert joined.agg(F.sum("claim_count")).first()[0] == 200 * 30 + 60


def test_hot_premium_key_is_split(spark, session_conf):
    session_conf(SMALL_SKEW)
    joined = silver.join_claims(*_sides(spark, 9000, 900, True, False))
    assert "SortMergeJoin(skew=true)" in plan(joined)
    assert joined.count() == 9000
    assert joined.agg(F.sum("claim_count")).first()[0] == 3000 + 600


def test_hot_claim_key_is_split(spark, session_conf):
    session_conf(SMALL_SKEW)
    joined = silver.join_claims(*_sides(spark, 900, 9000, False, True), repeated_claim_keys=True)
    assert "SortMergeJoin(skew=true)" in plan(joined)
    assert joined.count() == 3000 + 899


def test_broadcasts_can_be_switched_off(spark, session_conf):
    session_conf(NO_BROADCAST)
    text = plan(silver.join_claims(*_sides(spark, 900, 90, True, False)))
    assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text


def test_malformed_claims_can_be_kept(spark):
    claim = silver.type_claim(edge_claim(spark), keep_malformed=True)
    flagged = {r.claim_coverage for r in claim.where("claim_malformed").collect()}
    assert flagged == {"X5", "X6"}
    joined = silver.join_claims(silver.type_premium(edge_premium(spark)), claim)
    assert "claim_malformed" in joined.columns


def test_repeated_claims(typed):
    found = silver.repeated_claims(typed[1]).collect()
    assert [(r.claim_coverage, r.copies) for r in found] == [("X9", 2)]


def test_claim_copies(typed):
    copies = {(r.claim_region_code, r.claim_coverage): r.claim_copies
              for r in silver.with_claim_copies(typed[1]).collect()}
    assert copies[("01", "X9")] == 2 and copies[("01", "APP")] is None
    assert silver.with_claim_copies(typed[1]).count() == typed[1].count()


def test_orphan_claims(spark, typed):
    extra = edge_claim(spark, [("77", "APP", "1", "1")])
    claim = silver.type_claim(edge_claim(spark).unionByName(extra))
    orphans = silver.orphan_claims(typed[0], claim)
    assert {(r.claim_region_code, r.claim_coverage) for r in orphans.collect()} == {
        ("77", "APP"), (None, "APP"),
    }


def test_enrich_keeps_unlisted_regions(spark, typed):
    named = silver.enrich(typed[0], edge_regions(spark))
    names = {r.region_code: r.region_name for r in named.collect()}
    assert names == {"01": "one", "02": "two", "99": None, None: None}
    assert named.count() == typed[0].count() and "dim_code" not in named.columns


def test_unknown_regions(spark, typed):
    unknown = silver.unknown_regions(typed[0], edge_regions(spark)).collect()
    assert [r.region_code for r in unknown] == ["99"]


def test_large_dimension_is_not_broadcast(spark, session_conf, typed):
    """Beyond the size threshold the lookup shuffles instead."""
    regions = edge_regions(spark)
    expected = sorted(map(str, rows(silver.enrich(typed[0], regions))))
    session_conf(NO_BROADCAST)
    named = silver.enrich(typed[0], regions)
    text = plan(named)
    assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
    assert sorted(map(str, rows(named))) == expected


def test_require_unique(spark):
    regions = edge_regions(spark)
    assert silver.require_unique(regions) is regions
    with pytest.raises(ValueError, match="01"):
        silver.require_unique(regions.unionByName(regions.where("dim_code = '01'")))


def test_period_constant(typed):
    assert {r.period for r in typed[0].collect()} == {PERIOD}
