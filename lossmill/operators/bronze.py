"""Run metadata on raw rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossmill.schemas import PERIOD


def stamp(df: DataFrame, run_ts: datetime, period: str | None = None) -> DataFrame:
    """Add period, ingest time and source file.

    The files carry no date, so the period is given; with ``None`` the frame already has one (a
    scan of period directories). ``run_ts`` is one instant for the whole run. Must be applied
    straight after the file scan, where the file of a row is still known.
    """
    columns = {"ingested_at": F.lit(run_ts), "source_file": F.col("_metadata.file_path")}
    if period is not None:
        columns = {PERIOD: F.lit(period)} | columns
    return df.withColumns(columns)
