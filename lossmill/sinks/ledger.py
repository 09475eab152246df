"""An append-only record of what each run did to which table, in numbered versions.

A version is claimed before a table changes, by creating a marker file that only one writer can
create, and entered after the change. So versions of a table are in the order of its changes, a
version without an entry is a run that did not finish, and a writer that began from an older
version than the present one finds out before it overwrites anything.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import astuple, dataclass, replace
from datetime import datetime
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossmill.schemas import LEDGER
from lossmill.sinks.files import Files
from lossmill.sources.tables import read_table


@dataclass(frozen=True)
class Entry:
    """One finished replacement. Written after its table, so a missing entry marks a run that
    did not finish."""

    table_name: str
    period: str
    operation: str
    row_count: int
    run_ts: datetime
    version: int | None = None


class Conflict(RuntimeError):
    """Another writer changed the same periods of a table in the meantime."""


def _markers(path: str, table: str) -> str:
    # Spark does not read folders whose names begin with an underscore.
    return f"{path.rstrip('/')}/_versions/{quote(table, safe='')}"


def current_versions(spark: SparkSession, path: str, tables: Iterable[str]) -> dict[str, int]:
    """The latest claimed version of each table, 0 for one that was never written."""
    files = Files(spark)
    return {
        t: max((int(n) for n in files.names(_markers(path, t)) if n.isdigit()), default=0)
        for t in tables
    }


def claim_version(
    spark: SparkSession, path: str, table: str, periods: Iterable[str], base: int | None = None
) -> int:
    """Take the next version of a table.

    With ``base``, the version that the new rows were made from, a version that another writer took
    since is a ``Conflict``, unless its entries are there and name other periods only.
    """
    files = Files(spark)
    version = (current_versions(spark, path, [table])[table] if base is None else base) + 1
    while not files.create_new(f"{_markers(path, table)}/{version}"):
        if base is not None:
            _require_other_periods(spark, path, table, version, set(periods))
        version += 1
    return version


def _require_other_periods(
    spark: SparkSession, path: str, table: str, version: int, periods: set[str]
) -> None:
    same = (F.col("table_name") == table) & (F.col("version") == version)
    entries = read_table(spark, path, LEDGER).where(same).select("period").collect()
    if not entries or periods & {r.period for r in entries}:
        raise Conflict(f"{table}: another writer has taken version {version}; run again")


def append_ledger(spark: SparkSession, path: str, entries: Sequence[Entry]) -> None:
    """Append entries. Those of a table that carry no version get its next one together."""
    taken: dict[str, int] = {}
    for table in dict.fromkeys(e.table_name for e in entries if e.version is None):
        periods = [e.period for e in entries if e.table_name == table]
        taken[table] = claim_version(spark, path, table, periods)
    numbered = _with_versions(entries, taken)
    rows = spark.createDataFrame([astuple(e) for e in numbered], LEDGER)
    rows.coalesce(1).write.mode("append").parquet(path)


def _with_versions(entries: Sequence[Entry], taken: Mapping[str, int]) -> list[Entry]:
    return [
        replace(e, version=taken[e.table_name]) if e.version is None else e for e in entries
    ]


def last_operations(
    spark: SparkSession, path: str, n: int = 3, table_name: str | None = None
) -> DataFrame:
    """The latest ``n`` entries, newest first; of one table when it is named."""
    ledger = read_table(spark, path, LEDGER)
    if table_name is not None:
        ledger = ledger.where(F.col("table_name") == table_name)
    newest = (F.desc("run_ts"), "table_name", F.desc("version"), F.desc("period"))
    return ledger.orderBy(*newest).limit(n)
