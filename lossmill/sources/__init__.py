"""Readers: delimited files, period-partitioned tables, the star-schema binding."""

from lossmill.sources.delimited import (
    read_delimited,
    read_regions,
    require_periods,
    require_rows,
    rows_per_period,
)
from lossmill.sources.tables import read_period, read_table

__all__ = [
    "read_delimited",
    "read_period",
    "read_regions",
    "read_table",
    "require_periods",
    "require_rows",
    "rows_per_period",
]
