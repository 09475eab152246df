"""Premium, claim and region frames out of an orders star schema.

The frames have the shape of the published files (all text, comma decimals) plus the period. All
given rows are kept. So that every quality rule has something to find, a few rows with faults, under
region codes and coverages of their own, are added to every period.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lossmill.functions import comma_text
from lossmill.schemas import PERIOD
from lossmill.sources.delimited import FILE_ENCODING, FILE_FORMAT

# The added rows. Region 99 is not in the dimension, F_ALONE has no claim, F_ORPHAN
# no premium, F_TEXT a claim that does not parse, and F_TWICE two claims.
FAULT_REGION, FAULT_NAME = "90", "ADDED REGION"
FAULT_PREMIUMS = (
    (None, FAULT_NAME, "F_NULL", "1,0000", "10,0000", "10,0000"),
    ("90", FAULT_NAME, "F_DIGITS", "1,0000", "n/d", "10,0000"),
    ("90", FAULT_NAME, "F_ZERO", "1,0000", "0,0000", "10,0000"),
    ("90", FAULT_NAME, "F_NEGATIVE", "1,0000", "10,0000", "10,0000"),
    ("90", FAULT_NAME, "F_ALONE", "2,0000", "1000,5000", "500,2500"),
    ("90", FAULT_NAME, "F_TEXT", "1,0000", "10,0000", "10,0000"),
    ("90", FAULT_NAME, "F_TWICE", "4,0000", "250,0000", "62,5000"),
    ("99", "NOT LISTED", "F_UNLISTED", "1,0000", "10,0000", "10,0000"),
)
FAULT_CLAIMS = (
    ("90", FAULT_NAME, "F_ZERO", "1", "5,0000"),
    ("90", FAULT_NAME, "F_NEGATIVE", "1", "-5,0000"),
    ("90", FAULT_NAME, "F_TEXT", "x", "n/d"),
    ("90", FAULT_NAME, "F_TWICE", "1", "100,0000"),
    ("90", FAULT_NAME, "F_TWICE", "2", "400,2500"),
    ("90", FAULT_NAME, "F_ORPHAN", "1", "7,0000"),
    ("99", "NOT LISTED", "F_UNLISTED", "1", "3,0000"),
)


def _half_year(c: str) -> Column:
    return F.concat(
        F.year(c).cast("string"), F.when(F.month(c) <= 6, "S1").otherwise("S2")
    )


def _code(c: str) -> Column:
    return F.lpad(F.col(c).cast("string"), 2, "0")


def _hundredths(c: str) -> Column:
    """An amount of two decimals as a whole number, which sums up exactly in any order."""
    return F.rint(F.col(c) * 100).cast("bigint")


def _decimal_sum(whole: Column, digits: int) -> Column:
    """Sum of whole numbers, scaled back by ``digits`` decimals. Wide enough for any sum."""
    scale = F.lit(f"{10**-digits:.{digits}f}").cast(f"decimal({digits + 1},{digits})")
    return F.sum(whole.cast("decimal(28,0)")) * scale


class Star:
    """The frames of one star schema. Each table is opened once: listing the files of a large table
    is not free, and the premium and the claim side share orders, customers and nations."""

    def __init__(self, spark: SparkSession, sf_dir: str, faults: bool = True):
        self._spark, self._dir, self._faults = spark, sf_dir, faults

    def _table(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._dir}/{name}.parquet")

    @cached_property
    def _orders(self) -> DataFrame:
        return self._table("orders").select(
            "o_orderkey", "o_custkey", "o_totalprice", _half_year("o_orderdate").alias("period")
        )

    @cached_property
    def _nation(self) -> DataFrame:
        return self._table("nation").select("n_nationkey", "n_name")

    @cached_property
    def _order_segments(self) -> DataFrame:
        """Orders with the nation and coverage of their customer.

        Neither side carries a hint: customers grow with the data, so their size decides at run
        time between broadcast and a sort-merge join, whose skewed partitions adaptive execution
        splits.
        """
        customer = self._table("customer").select(
            "c_custkey", "c_nationkey", F.col("c_mktsegment").alias("coverage")
        )
        return self._orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))

    @cached_property
    def _order_lines(self) -> DataFrame:
        """Line count and net amount per order, summed on the map side before the shuffle.

        The join on the order key then finds this side partitioned already, and an order with very
        many lines arrives as one row per map task.
        """
        amount = F.sum(_hundredths("l_extendedprice") * (100 - _hundredths("l_discount")))
        return (
            self._table("lineitem")
            .groupBy("l_orderkey")
            .agg(F.count(F.lit(1)).alias("line_count"), amount.alias("line_amount"))
        )

    def _with_names(self, totals: DataFrame) -> DataFrame:
        return totals.join(self._nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")

    def _with_faults(self, frame: DataFrame, rows: tuple) -> DataFrame:
        """``frame`` and the added rows, once for every period there is."""
        if not self._faults:
            return frame
        names = [c for c in frame.columns if c != PERIOD]
        texts = [
            F.struct(*(F.lit(v).cast("string").alias(c) for c, v in zip(names, row)))
            for row in rows
        ]
        periods = self._orders.select(PERIOD).distinct()
        return frame.unionByName(periods.select(F.inline(F.array(*texts)), PERIOD))

    @cached_property
    def periods(self) -> tuple[str, ...]:
        """The half-years of the orders: a few labels, reduced before they are fetched."""
        return tuple(sorted(r[0] for r in self._orders.select("period").distinct().collect()))

    @cached_property
    def premium(self) -> DataFrame:
        sum_of_prices = _decimal_sum(_hundredths("o_totalprice"), 2)
        totals = self._order_segments.groupBy("period", "c_nationkey", "coverage").agg(
            F.count(F.lit(1)).alias("n"), sum_of_prices.cast("double").alias("total")
        )
        given = self._with_names(totals).select(
            _code("c_nationkey").alias("region_code"),
            F.col("n_name").alias("region_name"),
            "coverage",
            comma_text("n").alias("exposure"),
            comma_text("total").alias("premium"),
            comma_text(F.col("total") / F.col("n")).alias("avg_insured"),
            "period",
        )
        return self._with_faults(given, FAULT_PREMIUMS)

    @cached_property
    def claim(self) -> DataFrame:
        lines = self._order_lines.join(
            self._order_segments, F.col("l_orderkey") == F.col("o_orderkey")
        )
        amount = _decimal_sum(F.col("line_amount"), 4)
        totals = lines.groupBy("period", "c_nationkey", "coverage").agg(
            F.sum("line_count").alias("n"), amount.cast("double").alias("total")
        )
        given = self._with_names(totals).select(
            _code("c_nationkey").alias("region_code"),
            F.col("n_name").alias("region_name"),
            "coverage",
            F.col("n").cast("string").alias("claim_count"),
            comma_text("total").alias("claim_amount"),
            "period",
        )
        return self._with_faults(given, FAULT_CLAIMS)

    @cached_property
    def regions(self) -> DataFrame:
        listed = self._nation.select(
            _code("n_nationkey").alias("code"), F.col("n_name").alias("name")
        )
        if not self._faults:
            return listed
        added = self._spark.createDataFrame([(FAULT_REGION, FAULT_NAME)], listed.schema)
        return listed.unionByName(added)


def write_files(frame: DataFrame, path: str) -> str:
    """Write a raw frame the way the files are published, one directory per period."""
    writer = frame.write.options(**FILE_FORMAT, encoding=FILE_ENCODING)
    if PERIOD in frame.columns:
        writer = writer.partitionBy(PERIOD)
    writer.csv(path)
    return path
