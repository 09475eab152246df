"""Distinct counts that add up: sketches and bitmaps per period, merged over any set of periods.

A count of distinct values of one period says nothing about two periods together. What is stored
per period here does: HyperLogLog sketches merge to an estimate with a known error, bitmaps over
numbered values merge by OR to the exact count. Both are reduced where rows are read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossmill.schemas import PERIOD

LG_K = 12
_BUCKETS = 1024


def relative_error(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """How far, as a share of the true count, an estimate may lie off at so many standard errors.

    One standard error of a merged sketch of 2 ** lg_k cells is 1.04 over the root of their number.
    """
    return deviations * 1.04 / math.sqrt(1 << lg_k)


def sketches(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (PERIOD,), lg_k: int = LG_K
) -> DataFrame:
    """One row per key and column: ``column_name`` and ``sketch`` of its values, nulls left out."""
    parts = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.hll_sketch_agg(F.col(f"`{c}`").cast("string"), F.lit(lg_k)).alias("sketch"),
        ).alias(f"s{k}")
        for k, c in enumerate(columns)
    ]
    rows = df.groupBy(*by).agg(*parts)
    return rows.select(*by, F.inline(F.array(*(f"s{k}" for k in range(len(parts))))))


def estimates(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``approx_distinct`` per column from sketches of any rows of ``sketches``, merged."""
    merged = parts.groupBy(*by, "column_name").agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(
        *by, "column_name", F.hll_sketch_estimate("sketch").alias("approx_distinct")
    )


def numbered(values: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``value`` and ``number`` for every distinct, non-null ``value``, from 0 without gaps.

    ``known`` is the result for earlier periods: its values keep their numbers and new ones follow.
    Values are numbered within buckets of their hashes and the buckets laid end to end, so no task
    orders all of them.
    """
    fresh = values.select("value").where("value is not null").distinct()
    start = F.lit(0).cast("long")
    if known is not None:
        fresh = fresh.join(known, "value", "left_anti")
        start = F.lit(known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]).cast("long")
    fresh = fresh.withColumn("bucket", F.pmod(F.xxhash64("value"), F.lit(_BUCKETS)))
    sizes = fresh.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("size").over(earlier), F.lit(0))
    sizes = sizes.select("bucket", first.alias("first"))
    inside = F.row_number().over(Window.partitionBy("bucket").orderBy("value")) - 1
    new = fresh.withColumn("inside", inside).join(sizes, "bucket")
    new = new.select("value", (start + F.col("first") + F.col("inside")).alias("number"))
    return new if known is None else known.select("value", "number").unionByName(new)


def bitmaps(
    df: DataFrame, column: str, numbers: DataFrame, by: Sequence[str] = (PERIOD,)
) -> DataFrame:
    """One row per key and stretch of numbers: ``bucket`` and the ``bitmap`` of the values there.

    Rows are made distinct before they meet the numbers, so the join does not see how often a value
    occurs. Null values are in no bitmap.
    """
    seen = df.select(*by, F.col(f"`{column}`").alias("value")).distinct().join(numbers, "value")
    # The functions count positions from 1.
    place = F.col("number") + 1
    return seen.groupBy(*by, F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bitmap")
    )


def count_of(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``n_distinct`` from bitmaps of any rows of ``bitmaps``, merged by OR: the exact count."""
    merged = parts.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    total: Column = F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).cast("long")
    return merged.groupBy(*by).agg(total.alias("n_distinct"))
