"""Reports over several periods and over columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType

from lossmill.functions import exact_sum, round_snap


def trend_by_region(region_mart: DataFrame) -> DataFrame:
    """Ratio per region and period with the one of the previous stored period and the change.

    ``previous_period`` says which that is: with a half-year missing, it lies further back. Runs
    over the region mart, so a window partition holds one row per period.
    """
    history = Window.partitionBy("region_code").orderBy("period")
    return region_mart.select(
        "region_code",
        "region_name",
        "period",
        "loss_ratio",
        F.lag("period").over(history).alias("previous_period"),
        F.lag("loss_ratio").over(history).alias("previous_ratio"),
    ).withColumn("ratio_change", round_snap(F.col("loss_ratio") - F.col("previous_ratio"), 4))


def _half_year_number(period: Column) -> Column:
    """``2019S1`` as a number that grows by one with every half-year; null for other names."""
    year = F.regexp_extract(period, r"^(\d{4})S[12]$", 1).try_cast("int")
    return year * 2 + F.when(period.endswith("S2"), 1).otherwise(0)


def _half_year_name(number: Column) -> Column:
    half = F.when(number % 2 == 1, "S2").otherwise("S1")
    return F.concat(F.lpad(F.floor(number / 2).cast("string"), 4, "0"), half)


def calendar_trend(region_mart: DataFrame) -> DataFrame:
    """Ratio per region and half-year with that of the half-year before and of a year before.

    A spine of all half-years between the first and the last one stored is laid under every region,
    so ``previous_ratio`` is that of the neighbour in time, and a region without rows for a
    half-year has a row with ``reported`` false and null ratios. The code names a region; its name
    is the latest one. Periods that are no half-years are an error. The bounds are looked up when
    this is called.
    """
    number = _half_year_number(F.col("period"))
    foreign = F.raise_error(F.concat(F.lit("not a half-year: "), F.col("period")))
    rows = region_mart.select(
        "region_code",
        "region_name",
        "loss_ratio",
        F.when(number.isNull(), foreign.cast("int")).otherwise(number).alias("number"),
    )
    low, high = rows.agg(F.min("number"), F.max("number")).first()
    latest = F.max_by("region_name", "number").alias("region_name")
    regions = rows.groupBy("region_code").agg(latest)
    spine = F.sequence(F.lit(low).cast("int"), F.lit(high).cast("int"))
    every = regions.select("region_code", "region_name", F.explode(spine).alias("number"))
    known = rows.select("region_code", "number", "loss_ratio", F.lit(True).alias("reported"))
    joined = every.join(
        known.toDF("code", "at", "loss_ratio", "reported"),
        F.col("region_code").eqNullSafe(F.col("code")) & (F.col("number") == F.col("at")),
        "left",
    )
    history = Window.partitionBy("region_code").orderBy("number")
    change = round_snap(F.col("loss_ratio") - F.col("previous_ratio"), 4)
    return joined.select(
        "region_code",
        "region_name",
        _half_year_name(F.col("number")).alias("period"),
        F.coalesce("reported", F.lit(False)).alias("reported"),
        "loss_ratio",
        F.lag("loss_ratio").over(history).alias("previous_ratio"),
        F.lag("loss_ratio", 2).over(history).alias("year_before_ratio"),
    ).withColumn("ratio_change", change)


def exposure_weighted_ratio(silver: DataFrame) -> DataFrame:
    """Mean of row ratios weighted by exposure, per region and period."""
    rated = F.when(F.col("loss_ratio").isNotNull(), F.col("exposure"))
    weighted = exact_sum(F.col("loss_ratio") * F.col("exposure"))
    weight = exact_sum(rated)
    return silver.groupBy("region_code", "region_name", "period").agg(
        round_snap(F.try_divide(weighted, weight), 4).alias("weighted_ratio")
    )


def _shown(c: Column, kind: DataType) -> Column:
    """A value as text; doubles with four decimals rather than in exponent form."""
    if isinstance(kind, DoubleType):
        return F.coalesce(F.round(c, 4).try_cast("decimal(28,4)").cast("string"), c.cast("string"))
    return c.cast("string")


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: rows, nulls, null rate, min, max and approximate distinct count.

    All columns are measured in one aggregation and turned into rows afterwards.
    """
    names = list(columns or df.columns)
    measures = []
    for i, name in enumerate(names):
        c, kind = F.col(f"`{name}`"), df.schema[name].dataType
        measures.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.count(F.lit(1)).alias("row_count"),
                F.count_if(c.isNull()).alias("null_count"),
                _shown(F.min(c), kind).alias("min_value"),
                _shown(F.max(c), kind).alias("max_value"),
                F.approx_count_distinct(c).alias("approx_distinct"),
            ).alias(f"m{i}")
        )
    rows = df.agg(*measures).select(F.inline(F.array(*(f"m{i}" for i in range(len(names))))))
    rate = F.coalesce(round_snap(F.try_divide("null_count", F.col("row_count")), 4), F.lit(0.0))
    return rows.withColumn("null_rate", rate)
