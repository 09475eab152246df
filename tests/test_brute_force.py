"""Random small inputs against the same rules written as plain Python loops."""

from __future__ import annotations

from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lossmill.operators import marts, quality, silver
from lossmill.plans.medallion import tagged_rows
from tests.fixtures import edge_claim, edge_premium, edge_regions

REGIONS = st.sampled_from(["01", "02", "77", None])
COVERAGES = st.sampled_from(["A", "B", None])
AMOUNTS = st.one_of(
    st.sampled_from(["n/d", "0", "-3,5", None]),
    st.integers(1, 10**7).map(lambda n: f"{n / 100:.2f}".replace(".", ",")),
)
PREMIUM = st.lists(st.tuples(REGIONS, COVERAGES, AMOUNTS), max_size=12)
COUNTS = st.sampled_from(["1", "2,5", "7"])
CLAIM = st.lists(st.tuples(REGIONS, COVERAGES, COUNTS, AMOUNTS), max_size=8)
NAMES = {"01": "one", "02": "two"}


def half_up(value: Decimal, digits: int) -> float:
    return float(value.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def number(text):
    try:
        return Decimal(text.replace(",", "."))
    except Exception:
        return None


def expected_rows(premium, claim):
    for region, coverage, text in premium:
        amount = number(text)
        matches = [
            (int(n) if n.isdigit() else 0, number(a) or Decimal(0))
            for r, c, n, a in claim
            if None not in (r, c) and (r, c) == (region, coverage)
        ]
        for count, paid in matches or [(0, Decimal(0))]:
            ratio = half_up(paid / amount, 4) if amount is not None and amount > 0 else None
            if region is None:
                reason = "region_null"
            elif amount is None:
                reason = "premium_null"
            elif amount <= 0:
                reason = "premium_not_positive"
            elif paid < 0:
                reason = "claim_negative"
            else:
                reason = None if region in NAMES else "region_unknown"
            yield region, coverage, amount, count, paid, ratio, reason


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(premium=PREMIUM, claim=CLAIM)
def test_silver_and_region_mart(spark, premium, claim):
    tagged = tagged_rows(
        silver.type_premium(edge_premium(spark, premium)),
        silver.type_claim(edge_claim(spark, claim)),
        edge_regions(spark),
    )
    wanted = list(expected_rows(premium, claim))
    got = tagged.select(
        "region_code", "coverage", "premium", "claim_count", "claim_amount", "loss_ratio",
        "failure_reason",
    ).collect()
    as_floats = [
        (r, c, None if p is None else float(p), n, float(a), q, why)
        for r, c, p, n, a, q, why in wanted
    ]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, as_floats))

    sums = defaultdict(lambda: [Decimal(0), Decimal(0), 0])
    for region, coverage, amount, _, paid, _, reason in wanted:
        if reason is None:
            total = sums[region]
            total[0] += amount
            total[1] += paid
            total[2] += coverage is not None
    mart = marts.by_region(quality.split(tagged)[0]).collect()
    assert {
        r.region_code: (r.total_premium, r.total_claim_amount, r.loss_ratio, r.coverage_rows)
        for r in mart
    } == {
        region: (half_up(p, 2), half_up(c, 2), half_up(c / p, 4), n)
        for region, (p, c, n) in sums.items()
    }
