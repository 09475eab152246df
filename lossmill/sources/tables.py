"""Reads of the stored layers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lossmill.schemas import PERIOD

# Fixed value: the folder of rows whose partition column is null.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A whole stored table. The schema is given, so a period such as ``2019`` stays text.

    Spark moves partition columns to the end; the select puts them back in the schema's order.
    """
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def in_periods(periods: Iterable[str | None]) -> Column:
    """Whether a row is of the given periods; ``None`` stands for rows without one."""
    wanted = set(periods)
    named = F.col(PERIOD).isin(*(p for p in wanted if p is not None))
    return named | F.col(PERIOD).isNull() if None in wanted else named


def read_period(
    spark: SparkSession,
    path: str,
    schema: StructType,
    periods: str | None | Iterable[str | None],
    outer: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """The partitions of the given periods.

    Only their directories are listed, so the cost follows the periods asked for, not the history.
    ``outer`` names partition columns above the period and the values wanted of them. A period
    that was never written has no rows; a table that was never written is an error.
    """
    wanted = [periods] if isinstance(periods, str) or periods is None else list(set(periods))
    base = path.rstrip("/")
    levels = [[f"{c}={v}" for v in values] for c, values in (outer or {}).items()]
    levels.append([f"{PERIOD}={NULL_FOLDER if p is None else p}" for p in wanted])
    folders = ["/".join((base, *parts)) for parts in product(*levels)]
    there = _existing(spark, [base, *folders])
    if base in there and there != {base}:
        rows = spark.read.schema(schema).option("basePath", base).parquet(*sorted(there - {base}))
        return rows.select(*schema.names).where(in_periods(wanted))
    condition = in_periods(wanted)
    for column, values in (outer or {}).items():
        condition = condition & F.col(column).isin(*values)
    return read_table(spark, path, schema).where(condition)


def _existing(spark: SparkSession, folders: list[str]) -> set[str]:
    files = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    paths = {folder: files.Path(folder) for folder in folders}
    return {folder for folder, p in paths.items() if p.getFileSystem(conf).exists(p)}
