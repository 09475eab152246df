"""Idempotent replacement of the periods of a Parquet table.

New partitions are written to a hidden folder beside the table, where their rows are counted. Only
then are they swapped in, folder by folder, or discarded. So a write that fails, or turns out not to
have what it should, leaves the stored rows as they were.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lossmill.operators.quality import REASON
from lossmill.schemas import PERIOD
from lossmill.sinks.files import Files
from lossmill.sources.tables import NULL_FOLDER, read_period

OUTCOME = "outcome"
CLEAN, QUARANTINED = "clean", "quarantine"

_PERIOD_NAME = re.compile(r"[A-Za-z0-9._-]+")

Partition = tuple[str | None, ...]


def named_periods(periods: Iterable[str | None]) -> list[str | None]:
    """The periods in order, once each; a name that is no folder name is an error."""
    wanted = sorted(set(periods), key=lambda p: (p is None, p))
    if not wanted:
        raise ValueError("no period given")
    for period in wanted:
        if period is not None and not _PERIOD_NAME.fullmatch(period):
            raise ValueError(f"not a period name: {period!r}")
    return wanted


def _only(df: DataFrame, wanted: list[str | None]) -> DataFrame:
    """Fail the write when a row carries a period that is not replaced, or none unless none is.

    The test sits in the partition column itself: as a filter it could be moved into the scan and
    be tried on rows that are not part of ``df``.
    """
    period = F.col(PERIOD)
    foreign = F.raise_error(
        F.concat(F.lit("row outside the replaced periods: "), F.coalesce(period, F.lit("null")))
    )
    named = [p for p in wanted if p is not None]
    none = F.lit(None in wanted) & period.isNull()
    return df.withColumn(PERIOD, F.when(period.isin(*named) | none, period).otherwise(foreign))


def _folder(by: Sequence[str], partition: Partition) -> str:
    return "/".join(f"{c}={NULL_FOLDER if v is None else v}" for c, v in zip(by, partition))


@dataclass(frozen=True)
class Staged:
    """Partitions that are written, but not part of their table yet.

    ``targets`` names the folder of every partition that is replaced, also of those without rows.
    """

    spark: SparkSession
    folder: str
    by: tuple[str, ...]
    targets: Mapping[Partition, str]
    rows: int
    partitions: frozenset[Partition]
    made: tuple[str, ...]  # parent folders that were not there before

    def read(self) -> DataFrame:
        """The partition columns of the staged rows; counting them reads file footers only."""
        keys = StructType([StructField(c, StringType(), True) for c in self.by])
        return self.spark.read.schema(keys).parquet(self.folder)

    def counts(self) -> dict[Partition, int]:
        """Staged rows of every partition, zero for one without."""
        found = self.read().groupBy(*self.by).agg(F.count(F.lit(1))).collect()
        return dict.fromkeys(self.targets, 0) | {tuple(r)[:-1]: r[-1] for r in found}

    def swap(self) -> int:
        """Put the partitions in the place of the stored ones; returns the rows written.

        Stored folders are moved aside before theirs are filled anew, and deleted at the end. A
        run that died in between has no ledger entry and is repeated.
        """
        files = Files(self.spark)
        there = {}
        for parent in {target.rpartition("/")[0] for target in self.targets.values()}:
            files.make(parent)  # a table without rows can be read
            there[parent] = set(files.names(parent))
        for number, (partition, target) in enumerate(self.targets.items()):
            parent, _, name = target.rpartition("/")
            if name in there[parent]:
                files.move(target, f"{self.folder}/_old-{number}")
            if partition in self.partitions:
                files.move(f"{self.folder}/{_folder(self.by, partition)}", target)
        files.delete(self.folder)
        return self.rows

    def discard(self) -> None:
        """Leave everything as it was before."""
        files = Files(self.spark)
        files.delete(self.folder)
        for folder in self.made:
            if not files.names(folder):
                files.delete(folder)


def stage(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    targets: Mapping[Partition, str],
    rebalance: bool = False,
) -> Staged:
    """Write ``df`` beside the table at ``path``. Rows and partitions are observed in the same
    pass. A job that fails leaves nothing behind."""
    if rebalance:
        # Few, evenly sized files: a hot partition is split among tasks, small ones are joined.
        df = df.hint("rebalance", *(F.col(c) for c in by))
    spark, path = df.sparkSession, path.rstrip("/")
    files = Files(spark)
    folder = f"{path}/.staging-{uuid.uuid4().hex}"
    made = tuple(files.missing_above(folder))
    seen = Observation()
    observed = df.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.collect_set(F.struct(*by)).alias("partitions"),
    )
    try:
        observed.write.partitionBy(*by).parquet(folder)
    except Exception:
        Staged(spark, folder, tuple(by), targets, 0, frozenset(), made).discard()
        raise
    metrics = seen.get
    partitions = frozenset(tuple(row) for row in metrics["partitions"])
    return Staged(spark, folder, tuple(by), targets, metrics["rows"], partitions, made)


def stage_periods(
    df: DataFrame, path: str, periods: Iterable[str | None], rebalance: bool = False
) -> Staged:
    """Stage the rows of the given periods of the table at ``path``."""
    wanted = named_periods(periods)
    base = path.rstrip("/")
    targets = {(p,): f"{base}/{_folder([PERIOD], (p,))}" for p in wanted}
    return stage(_only(df, wanted), path, [PERIOD], targets, rebalance)


def stage_outcomes(
    df: DataFrame,
    path: str,
    periods: Iterable[str | None],
    failed: str = REASON,
    quarantine_path: str | None = None,
    rebalance: bool = False,
) -> Staged:
    """Stage clean and quarantined rows, those where ``failed`` is not null, in one pass.

    Both go under ``path`` in folders of their outcome, or to two tables of their own where
    ``quarantine_path`` is given.
    """
    wanted = named_periods(periods)
    outcome = F.when(F.col(failed).isNull(), CLEAN).otherwise(QUARANTINED)
    routed = _only(df, wanted).withColumn(OUTCOME, outcome)
    targets = {}
    for name in (CLEAN, QUARANTINED):
        for period in wanted:
            if quarantine_path is None:
                folder = f"{path.rstrip('/')}/{_folder([OUTCOME, PERIOD], (name, period))}"
            else:
                base = path if name == CLEAN else quarantine_path
                folder = f"{base.rstrip('/')}/{_folder([PERIOD], (period,))}"
            targets[name, period] = folder
    return stage(routed, path, [OUTCOME, PERIOD], targets, rebalance)


def replace_periods(
    df: DataFrame, path: str, periods: Iterable[str | None], rebalance: bool = False
) -> int:
    """Make the stored ``periods`` equal to ``df``; other periods stay untouched.

    The first call creates the table. Periods without rows in ``df`` end up empty. Running twice
    changes nothing. Returns the number of rows written. ``None`` among the periods stands for
    rows without one.

    A scan of period directories keeps periods apart, so its tasks write few files each. Set
    ``rebalance`` when several periods come out of a shuffle that mixed them; it costs one more.
    """
    return stage_periods(df, path, periods, rebalance).swap()


def replace_period(df: DataFrame, path: str, period: str) -> int:
    return replace_periods(df, path, [period])


def replace_outcomes(
    tagged: DataFrame, path: str, periods: Iterable[str | None], rebalance: bool = False
) -> int:
    """Replace the clean and the quarantined table of the given periods in one pass.

    Both lie under ``path``, see ``read_outcome``. The tagged rows are computed once, without a
    cache. A period that no longer has failures loses the failures of its earlier run.
    """
    return stage_outcomes(tagged, path, periods, rebalance=rebalance).swap()


def read_outcome(
    spark: SparkSession, path: str, schema: StructType, outcome: str, periods: Iterable[str]
) -> DataFrame:
    """The clean or the quarantined table that ``replace_outcomes`` keeps under ``path``."""
    with_outcome = StructType(schema.fields + [StructField(OUTCOME, StringType(), True)])
    rows = read_period(spark, path, with_outcome, periods, {OUTCOME: (outcome,)})
    return rows.drop(OUTCOME)


def period_counts(df: DataFrame) -> DataFrame:
    """Rows per period. Over a stored table this reads file footers only."""
    return df.groupBy(PERIOD).agg(F.count(F.lit(1)).alias("row_count"))


def reconcile(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per layer and period, to hold source, bronze and silver side by side."""
    rows = [df.select(F.lit(name).alias("layer"), PERIOD) for name, df in layers.items()]
    everything = reduce(DataFrame.unionByName, rows)
    return everything.groupBy("layer", PERIOD).agg(F.count(F.lit(1)).alias("row_count"))
