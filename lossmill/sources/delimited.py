"""Delimited text files with a fixed schema."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lossmill.schemas import PERIOD, REGION_FILE

# The format of the published files.
FILE_FORMAT = {"header": "true", "sep": ";", "nullValue": "", "emptyValue": ""}
FILE_ENCODING = "ISO-8859-1"

CORRUPT = "_corrupt_record"


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    sep: str = FILE_FORMAT["sep"],
    encoding: str = FILE_ENCODING,
    keep_corrupt: bool = False,
    period_dirs: bool = False,
) -> DataFrame:
    """Scan delimited files without inference. Columns are matched by position.

    Lines are split by the file reader, so a large file is read by many tasks. With
    ``keep_corrupt`` lines that are too short or too long also show in ``_corrupt_record``; by
    default they are padded or cut. With ``period_dirs`` the files lie in ``period=...``
    directories and the period is read from the directory name as text.
    """
    fields = list(schema.fields)
    if keep_corrupt:
        fields.append(StructField(CORRUPT, StringType(), True))
    if period_dirs:
        fields.append(StructField("period", StringType(), True))
    options = FILE_FORMAT | {"sep": sep, "encoding": encoding}
    if keep_corrupt:
        options["columnNameOfCorruptRecord"] = CORRUPT
    return spark.read.schema(StructType(fields)).options(**options).csv(path)


def read_regions(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """The region dimension: code and official name, renamed for the join."""
    raw = read_delimited(spark, path, REGION_FILE, **options)
    return raw.withColumnsRenamed({"code": "dim_code", "name": "region_name"})


def require_rows(df: DataFrame, minimum: int = 1, what: str = "source") -> DataFrame:
    """Return ``df``, or raise when it has fewer than ``minimum`` rows. Reads no column and no more
    rows than that."""
    found = df.select(F.lit(1)).limit(minimum).count() if minimum > 0 else 0
    if found < minimum:
        raise ValueError(f"{what}: expected at least {minimum} row(s), found {found}")
    return df


def rows_per_period(df: DataFrame, periods: Iterable[str]) -> DataFrame:
    """Rows of each of the given periods, zero where there are none."""
    spark = df.sparkSession
    wanted = spark.createDataFrame([(p,) for p in sorted(set(periods))], f"{PERIOD} string")
    found = df.groupBy(PERIOD).agg(F.count(F.lit(1)).alias("row_count"))
    joined = wanted.join(found, PERIOD, "left")
    rows = F.coalesce("row_count", F.lit(0)).cast("bigint")
    return joined.select(PERIOD, rows.alias("row_count"))


def require_periods(
    df: DataFrame, periods: Iterable[str], minimum: int = 1, what: str = "source"
) -> DataFrame:
    """Return ``df``, or raise with the name of every period that has fewer than ``minimum``
    rows."""
    counts = rows_per_period(df, periods).where(F.col("row_count") < minimum)
    short = {row[PERIOD]: row["row_count"] for row in counts.orderBy(PERIOD).collect()}
    if short:
        raise ValueError(f"{what}: expected at least {minimum} row(s) per period, found {short}")
    return df
