from __future__ import annotations

import math
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lossmill.functions import (
    comma_decimal,
    comma_text,
    exact_sum,
    is_malformed,
    loss_amount,
    loss_ratio,
    risk_tier,
    round_snap,
    summands,
    to_long,
)


def values(spark, kind, data, *columns):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    out = df.orderBy("i").select(*columns).collect()
    return [r[0] if len(columns) == 1 else tuple(r) for r in out]


def test_comma_decimal(spark):
    texts = ["369319,443", "12", "-5,5", "n/d", "1.234,56", "1,234,5", "", " 7,5 ", None]
    expected = [369319.443, 12.0, -5.5, None, None, None, None, 7.5, None]
    assert values(spark, "string", texts, comma_decimal("v")) == expected


def test_comma_decimal_strict(spark):
    texts = ["1e3", "1d", "Infinity", "12,5", "NaN", "n/d", None]
    loose = values(spark, "string", texts, comma_decimal("v"))
    assert loose[:4] == [1000.0, 1.0, math.inf, 12.5] and math.isnan(loose[4])
    strict = values(spark, "string", texts, comma_decimal("v", strict=True))
    assert strict == [None, None, None, 12.5, None, None, None]


def test_to_long(spark):
    texts = ["12", "12.7", "abc", "", None, "-3"]
    assert values(spark, "string", texts, to_long("v")) == [12, None, None, None, None, -3]


def test_is_malformed(spark):
    flags = values(spark, "string", ["1", "x", None], is_malformed("v", to_long("v")))
    assert flags == [False, True, False]


def test_comma_text_has_no_exponent(spark):
    texts = values(spark, "double", [12412560.25, 0.00005, -3.0, None], comma_text("v"))
    assert texts == ["12412560,2500", "0,0001", "-3,0000", None]


def test_round_snap_ties_and_odd_values(spark):
    data = [2.675, 0.125, -0.125, 1.0049999999999999, None, math.inf, 1e25]
    got = values(spark, "double", data, round_snap("v", 2))
    assert got == [2.68, 0.13, -0.13, 1.01, None, math.inf, 1e25]
    assert math.isnan(values(spark, "double", [math.nan], round_snap("v", 2))[0])


@settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.integers(-(10**9), 10**9), min_size=1, max_size=50))
def test_round_snap_rounds_half_up(spark, thousandths):
    data = [n / 1000 for n in thousandths]
    expected = [
        float((Decimal(n) / 1000).quantize(Decimal("0.01"), ROUND_HALF_UP)) for n in thousandths
    ]
    assert values(spark, "double", data, round_snap("v", 2)) == expected


def test_loss_ratio(spark):
    data = [(1.0, 3.0), (1.0, 0.0), (1.0, -1.0), (1.0, None), (None, 3.0), (0.0, 3.0)]
    df = spark.createDataFrame(data, "a double, b double")
    assert [r[0] for r in df.select(loss_ratio("a", "b")).collect()] == [
        0.3333, None, None, None, None, 0.0,
    ]
    assert df.select(loss_ratio("a", "b", decimals=2)).first()[0] == 0.33
    assert df.select(loss_ratio("a", "b", decimals=0)).first()[0] == 0.0


def test_loss_amount(spark):
    df = spark.createDataFrame([(45678901.0, 35678901.234567)], "a double, b double")
    assert df.select(loss_amount("a", "b")).first()[0] == 9999999.77


@pytest.mark.parametrize(
    ("ratio", "tier"),
    [(1.0001, "HIGH"), (1.0, "WATCH"), (0.7001, "WATCH"), (0.7, "HEALTHY"), (None, "HEALTHY")],
)
def test_risk_tier(spark, ratio, tier):
    assert values(spark, "double", [ratio], risk_tier("v")) == [tier]


def test_risk_tier_takes_bands(spark):
    assert values(spark, "double", [0.6], risk_tier("v", high=0.5, watch=0.2)) == ["HIGH"]


def test_summands_split_every_value(spark):
    data = [0.1, -2.5, 98234.123456789, 1e-12, 4e-13, 1e30, math.inf, None, 9e17]
    names = list(summands("v"))
    got = values(spark, "double", data, *summands("v").values())
    found = [{n: x for n, x in zip(names, row) if x is not None} for row in got]
    assert found == [
        {"units": 0, "parts": 1000},
        {"units": -2, "parts": -5000},
        {"units": 98234, "parts": 1234, "crumbs": 56789},
        {"odd": Decimal("1E-12")},
        {"rest": 4e-13},
        {"rest": 1e30},
        {"rest": math.inf},
        {},
        {"odd": Decimal("900000000000000000.000000000000")},
    ]


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.one_of(
            st.integers(-(10**12), 10**12).map(lambda n: n / 10**4),
            st.integers(-(10**14), 10**14).map(lambda n: n / 10**9),
            st.floats(-1e15, 1e15).filter(lambda x: abs(x) > 1),
        ),
        max_size=40,
    )
)
def test_exact_sum_adds_the_digits(spark, data):
    got = spark.createDataFrame([(v,) for v in data], "v double").select(exact_sum("v")).first()[0]
    if not data:
        assert got is None
    elif all(Decimal(repr(v)) == round(Decimal(repr(v)), 12) for v in data):
        assert got == pytest.approx(float(sum(Decimal(repr(v)) for v in data)), rel=1e-15)


@pytest.mark.parametrize("below", [1e-6, 1e-7, 1e-8, 1e-9, 1e-10])
def test_rounding_beside_ties(spark, below):
    ties = [Decimal("1.00005"), Decimal("0.70005"), Decimal("0.12345"), Decimal("12.00015")]
    data = [float(t + s * Decimal(repr(below))) for t in ties for s in (-1, 1)]
    expected = [
        float(Decimal(repr(v)).quantize(Decimal("0.0001"), ROUND_HALF_UP)) for v in data
    ]
    assert values(spark, "double", data, round_snap("v", 4)) == expected


def test_ratios_just_below_a_tie(spark):
    pairs = [(562535854.0, 562507729.0), (700049996.0, 1e9)]
    df = spark.createDataFrame(pairs, "claims double, premium double")
    ratio = loss_ratio("claims", "premium")
    got = [tuple(r) for r in df.select(ratio, risk_tier(ratio)).collect()]
    assert got == [(1.0, "WATCH"), (0.7, "HEALTHY")]
