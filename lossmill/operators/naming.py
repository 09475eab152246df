"""Table columns under the names of the published files."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lossmill.schemas import PUBLISHED_NAMES


def to_published(df: DataFrame, table: str = "silver") -> DataFrame:
    """Rename the columns that have a published name in ``table``, a key of ``PUBLISHED_NAMES``;
    others stay."""
    return df.withColumnsRenamed(PUBLISHED_NAMES[table])


def from_published(df: DataFrame, table: str = "silver") -> DataFrame:
    """The inverse of ``to_published``."""
    return df.withColumnsRenamed({new: old for old, new in PUBLISHED_NAMES[table].items()})
