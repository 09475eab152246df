from __future__ import annotations

import random
from itertools import combinations

from lossmill.operators import distincts, trends
from tests.conftest import rows

import pytest

PERIODS = ("2019S1", "2019S2", "2020S1", "2020S2")


def values(spark, n=4000, seed=1):
    rng = random.Random(seed)
    data = [(rng.choice(PERIODS), None if rng.random() < 0.02 else f"v{rng.randint(0, 900)}") for _ in range(n)]
    return data, spark.createDataFrame(data, "period string, v string")


def test_bitmaps_count_any_set_of_periods(spark):
    data, df = values(spark)
    numbers = distincts.numbered(df.selectExpr("v as value"))
    found = sorted(r.number for r in numbers.collect())
    assert found == list(range(len({v for _, v in data if v})))
    parts = distincts.bitmaps(df, "v", numbers).cache()
    for size in (1, 2, 3, 4):
        for some in combinations(PERIODS, size):
            (count,) = distincts.count_of(parts.where(parts.period.isin(*some))).first()
            assert count == len({v for p, v in data if v and p in some})
    per_period = dict(rows(distincts.count_of(parts, ["period"])))
    assert per_period == {p: len({v for q, v in data if v and q == p}) for p in PERIODS}


def test_later_values_get_later_numbers(spark):
    first = distincts.numbered(spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "value string"))
    both = distincts.numbered(spark.createDataFrame([("c",), ("b",), ("d",)], "value string"), first)
    old, new = dict(rows(first)), dict(rows(both))
    assert {k: new[k] for k in old} == old and set(old.values()) == {0, 1}
    assert sorted(new.values()) == [0, 1, 2, 3]
    none = spark.createDataFrame([], "value string")
    assert rows(distincts.numbered(none)) == []
    assert dict(rows(distincts.numbered(none, first))) == old


def test_numbers_beyond_one_bitmap(spark):
    df = spark.range(100_000).selectExpr("'p' as period", "id as v")
    numbers = distincts.numbered(df.selectExpr("v as value"))
    parts = distincts.bitmaps(df, "v", numbers)
    assert parts.count() == 4  # of 32,768 numbers each
    assert distincts.count_of(parts).first()[0] == 100_000


def test_sketches_merge_within_their_error(spark):
    df = spark.range(60_000).selectExpr(
        "concat('2019S', id % 2 + 1) as period", "id % 20000 as many", "cast(id % 7 as string) as few",
        "cast(null as string) as nothing",
    )
    parts = distincts.sketches(df, ["many", "few", "nothing"])
    assert parts.count() == 6
    found = dict(rows(distincts.estimates(parts)))
    assert abs(found["many"] - 20_000) <= 20_000 * distincts.relative_error()
    assert found["few"] == 7 and found["nothing"] == 0
    assert rows(distincts.estimates(parts.limit(0))) == []


def region_mart(spark, *data):
    return spark.createDataFrame(
        list(data), "region_code string, region_name string, period string, loss_ratio double"
    )


def test_calendar_shows_gaps_and_compares_neighbours(spark):
    mart = region_mart(
        spark, ("01", "A", "2019S1", 0.5), ("01", "B", "2020S1", 0.8), ("02", "C", "2019S2", 1.0),
        ("02", "C", "2020S1", None), (None, "N", "2020S1", 0.1),
    )
    got = trends.calendar_trend(mart).select(
        "region_code", "region_name", "period", "reported", "loss_ratio", "previous_ratio",
        "year_before_ratio", "ratio_change",
    )
    assert sorted(rows(got), key=str) == sorted(
        [
            ("01", "B", "2019S1", True, 0.5, None, None, None),
            ("01", "B", "2019S2", False, None, 0.5, None, None),
            ("01", "B", "2020S1", True, 0.8, None, 0.5, None),
            ("02", "C", "2019S1", False, None, None, None, None),
            ("02", "C", "2019S2", True, 1.0, None, None, None),
            ("02", "C", "2020S1", True, None, 1.0, None, None),
            (None, "N", "2019S1", False, None, None, None, None),
            (None, "N", "2019S2", False, None, None, None, None),
            (None, "N", "2020S1", True, 0.1, None, None, None),
        ],
        key=str,
    )
    changes = region_mart(spark, ("01", "A", "2019S2", 0.5), ("01", "A", "2020S1", 0.8))
    assert [r.ratio_change for r in trends.calendar_trend(changes).orderBy("period").collect()] == [None, 0.3]


def test_calendar_needs_half_years(spark):
    with pytest.raises(Exception, match="not a half-year: 2019"):
        trends.calendar_trend(region_mart(spark, ("01", "A", "2019", 0.5))).collect()
    assert trends.calendar_trend(region_mart(spark)).count() == 0
