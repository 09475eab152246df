"""The four marts and the small reports around them.

Every mart is a projection over mergeable totals. ``totals`` reduces rows on the map side, so only
one row per task and key is shuffled however hot a key is; ``merge`` rolls totals up further, and
``rolled_up`` does so to several grains at once, so that one scan serves several marts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossmill.functions import loss_amount, loss_ratio, risk_tier, round_snap, summands, summed

REGION = ("region_code", "region_name", "period")
COVERAGE = ("coverage", "period")
PORTFOLIO = ("period",)
SEGMENT = ("region_code", "region_name", "coverage", "period")

GRAIN = "grain"
#: The marts that are made of totals, by the grain of each.
GRAINS = {"by_region": REGION, "by_coverage": COVERAGE, "summary": PORTFOLIO}

_SUMMED = ("premium", "claim_amount", "exposure", "avg_insured")


def totals(silver: DataFrame, by: Sequence[str], loss_above: float = 1.0) -> DataFrame:
    """Mergeable totals per key. Amounts are summed as ``summands``, in any order the same."""
    return silver.groupBy(*by).agg(
        *(
            F.sum(part).alias(f"sum_{name}_{c}")
            for c in _SUMMED
            for name, part in summands(c).items()
        ),
        F.count("coverage").alias("n_coverage"),
        F.count("region_code").alias("n_region"),
        F.count("avg_insured").alias("n_avg_insured"),
        F.count_if(F.col("loss_ratio") > loss_above).alias("n_loss_making"),
        F.max("loss_ratio").alias("max_ratio"),
        F.min("loss_ratio").alias("min_ratio"),
    )


def _merged(parts: DataFrame) -> list[Column]:
    added = [c for c in parts.columns if c.startswith(("sum_", "n_"))]
    return [
        *(F.sum(c).alias(c) for c in added),
        F.max("max_ratio").alias("max_ratio"),
        F.min("min_ratio").alias("min_ratio"),
    ]


def merge(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Totals of a finer grain, rolled up to ``by``."""
    return parts.groupBy(*by).agg(*_merged(parts))


def rolled_up(
    parts: DataFrame, by: Sequence[str] = SEGMENT, grains: Mapping[str, Sequence[str]] = GRAINS
) -> DataFrame:
    """Totals by ``by``, rolled up to every one of ``grains`` in one aggregation.

    ``grain`` names the grain of a row; keys that are not of it are null. A key that is null in the
    data is a group of its own, told apart by the grouping sets' number.
    """
    sets = [[F.col(c) for c in keys] for keys in grains.values()]
    rolled = parts.groupingSets(sets, *(F.col(c) for c in by))
    rolled = rolled.agg(F.grouping_id().alias("__set"), *_merged(parts))
    grain = F.lit(None).cast("string")
    for name, keys in grains.items():
        # One bit per column of `by`, the first one highest, set where it is summed over.
        number = sum((c not in keys) << k for k, c in enumerate(reversed(by)))
        grain = F.when(F.col("__set") == number, name).otherwise(grain)
    return rolled.withColumn(GRAIN, grain).drop("__set")


def of_grain(rolled: DataFrame, name: str, grains: Mapping[str, Sequence[str]] = GRAINS) -> DataFrame:
    """The totals of one grain of ``rolled_up``."""
    others = {c for keys in grains.values() for c in keys}.difference(grains[name])
    return rolled.where(F.col(GRAIN) == name).drop(GRAIN, *others)


def _finished(parts: DataFrame) -> DataFrame:
    """Each sum as one double, then the ratio of sums."""
    names = summands("premium")
    whole = {c: summed({name: F.col(f"sum_{name}_{c}") for name in names}) for c in _SUMMED}
    ratio = loss_ratio("claim_amount", "premium")
    return parts.withColumns(whole).withColumn("loss_ratio", ratio)


def _sums() -> list[Column]:
    names = ("premium", "claim_amount", "exposure")
    return [round_snap(name, 2).alias(f"total_{name}") for name in names]


def sums_of_grains(rolled: DataFrame) -> DataFrame:
    """Sums and ratio of sums of every row of ``rolled_up``, with its grain and its keys."""
    return _finished(rolled).select(GRAIN, *SEGMENT, *_sums(), "loss_ratio")


def region_mart(parts: DataFrame, high: float = 1.0, watch: float = 0.7) -> DataFrame:
    """From totals by ``REGION``: sums, ratio of sums, row count and tier of the rounded ratio."""
    return _finished(parts).select(
        *REGION,
        *_sums(),
        "loss_ratio",
        F.col("n_coverage").alias("coverage_rows"),
        risk_tier("loss_ratio", high, watch).alias("risk_tier"),
    )


def coverage_mart(parts: DataFrame) -> DataFrame:
    """From totals by ``COVERAGE``: sums, ratio of sums, row count and mean insured amount."""
    mean = F.try_divide("avg_insured", F.col("n_avg_insured"))
    return _finished(parts).select(
        *COVERAGE,
        *_sums(),
        "loss_ratio",
        F.col("n_region").alias("region_rows"),
        round_snap(mean, 2).alias("mean_avg_insured"),
    )


def summary_mart(parts: DataFrame) -> DataFrame:
    """From totals by ``PORTFOLIO``: one row per period."""
    return _finished(parts).select(
        *PORTFOLIO,
        *_sums(),
        F.col("loss_ratio").alias("portfolio_loss_ratio"),
        F.col("n_region").alias("segments"),
        F.col("n_loss_making").alias("loss_making_segments"),
        round_snap("max_ratio", 4).alias("max_loss_ratio"),
        round_snap("min_ratio", 4).alias("min_loss_ratio"),
    )


def by_region(silver: DataFrame, high: float = 1.0, watch: float = 0.7) -> DataFrame:
    return region_mart(totals(silver, REGION), high, watch)


def by_coverage(silver: DataFrame) -> DataFrame:
    return coverage_mart(totals(silver, COVERAGE))


def summary(silver: DataFrame, loss_above: float = 1.0) -> DataFrame:
    return summary_mart(totals(silver, PORTFOLIO, loss_above))


def alerts(silver: DataFrame, threshold: float = 1.0) -> DataFrame:
    """Rows that paid out more than they took in, with the loss. Narrow: no shuffle."""
    return silver.where(F.col("loss_ratio") > threshold).select(
        "region_code",
        "region_name",
        "coverage",
        "premium",
        "claim_amount",
        "loss_ratio",
        "exposure",
        "period",
        loss_amount("claim_amount", "premium").alias("loss_amount"),
    )


def ranked(df: DataFrame, by: str, tiebreak: Sequence[str]) -> DataFrame:
    """Highest first, with key columns as tie break. For readers: a table keeps no order.

    Meant for marts, whose keys are unique: rows equal in every sort column all land in one task.
    """
    return df.orderBy(F.desc_nulls_last(by), *tiebreak)


def top_n(df: DataFrame, by: str, n: int, tiebreak: Sequence[str]) -> DataFrame:
    """The first ``n`` of ``ranked``; each task keeps n rows, nothing is sorted whole."""
    return ranked(df, by, tiebreak).limit(n)


def frequency(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count")).orderBy(column)


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct().orderBy(*columns)


def count_distinct(df: DataFrame, column: str, alias: str) -> DataFrame:
    return df.agg(F.count_distinct(column).alias(alias))
