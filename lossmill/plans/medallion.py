"""File to bronze to silver to gold, for one or many periods.

Layers meet only through stored tables, so each can be run again on its own.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import partial
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lossmill import schemas
from lossmill.operators import marts, quality, silver
from lossmill.operators.bronze import stamp
from lossmill.sinks import ledger, tables
from lossmill.sources.delimited import CORRUPT, FILE_ENCODING, read_delimited
from lossmill.sources.tables import read_period


T = TypeVar("T")


@dataclass(frozen=True)
class Settings:
    """Parameters of a run: where, which periods, which thresholds."""

    base: str
    periods: tuple[str, ...]
    loss_threshold: float = 1.0
    watch_threshold: float = 0.7
    alert_threshold: float = 2.0
    encoding: str = FILE_ENCODING
    strict_numbers: bool = False
    rules: tuple[quality.Rule, ...] = quality.RULES
    compact: bool = False  # one more shuffle of silver for fewer, evenly sized files
    may_be_empty: tuple[str, ...] = ()  # periods whose files may have no rows: they are cleared
    quarantine_lines: bool = False  # keep lines of too few or too many fields out of bronze
    repeated_claim_keys: bool = False  # a join that can split a hot, repeated claim key
    hot_claim_share: float | None = 0.02  # claim keys with more of all claims are dealt in parts
    run_ts: datetime = field(default_factory=lambda: datetime.now(timezone.utc))

    @property
    def stored_periods(self) -> tuple[str | None, ...]:
        return (*self.periods, None) if self.null_periods else self.periods

    @property
    def null_periods(self) -> bool:
        """Whether rows without a period belong to the run: a rule quarantines them."""
        return quality.PERIOD_NULL in self.rules

    def path(self, table: str) -> str:
        """``bronze/premium``, ``bronze/claim``, ``bronze/premium_lines``, ``bronze/claim_lines``,
        ``silver``, ``gold/by_region``, ``gold/by_coverage``, ``gold/alerts``, ``gold/summary`` or
        ``ledger``."""
        return f"{self.base.rstrip('/')}/{table}"


def read_silver(spark: SparkSession, run: Settings, outcome: str) -> DataFrame:
    """The clean or the quarantined rows of the periods of a run."""
    schema = schemas.SILVER if outcome == tables.CLEAN else schemas.QUARANTINE
    periods = run.stored_periods if outcome == tables.QUARANTINED else run.periods
    return tables.read_outcome(spark, run.path("silver"), schema, outcome, periods)


def read_tagged(spark: SparkSession, run: Settings) -> DataFrame:
    """Clean and quarantined rows together, for the quality reports."""
    both = {tables.OUTCOME: (tables.CLEAN, tables.QUARANTINED)}
    return read_period(spark, run.path("silver"), schemas.QUARANTINE, run.stored_periods, both)


def stored_layers(spark: SparkSession, run: Settings) -> dict[str, DataFrame]:
    """The bronze and silver tables of a run, its periods only."""
    bronze = {"premium": schemas.BRONZE_PREMIUM, "claim": schemas.BRONZE_CLAIM}
    if run.quarantine_lines:
        bronze |= {"premium_lines": schemas.PREMIUM_LINES, "claim_lines": schemas.CLAIM_LINES}
    return {
        f"bronze_{name}": read_period(spark, run.path(f"bronze/{name}"), schema, run.stored_periods)
        for name, schema in bronze.items()
    } | {
        f"silver_{outcome}": read_silver(spark, run, outcome)
        for outcome in (tables.CLEAN, tables.QUARANTINED)
    }


def _together(spark: SparkSession, actions: Sequence[Callable[[], T]]) -> list[T]:
    """Run independent Spark actions at the same time; small jobs then share the cluster."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(actions)) as pool:
        return list(pool.map(lambda action: inherit(action)(), actions))


@dataclass(frozen=True)
class _Write:
    """Staged partitions, and the table each outcome of them is entered under in the ledger."""

    staged: tables.Staged
    names: Mapping[str | None, str]

    def rows_of(self, counts: Mapping[tuple, int], name: str) -> dict[str | None, int]:
        """Rows per period of one table."""
        own = {outcome for outcome, table in self.names.items() if table == name}
        return {p[-1]: n for p, n in counts.items() if (p[0] if len(p) > 1 else None) in own}


def _staged(spark: SparkSession, actions: Sequence[Callable[[], _Write]]) -> list[_Write]:
    """Stage several tables at the same time; if one fails, what the others staged goes."""

    def attempt(action: Callable[[], _Write]) -> _Write | Exception:
        try:
            return action()
        except Exception as fault:
            return fault

    done = _together(spark, [partial(attempt, action) for action in actions])
    faults = [x for x in done if isinstance(x, Exception)]
    if faults:
        _discard([x for x in done if isinstance(x, _Write)])
        raise faults[0]
    return done


def _discard(writes: Sequence[_Write]) -> None:
    # Twice: a folder that several writes share is empty only when all of them are gone.
    for write in (*writes, *writes):
        write.staged.discard()


def _commit(
    spark: SparkSession,
    run: Settings,
    writes: Sequence[_Write],
    base: Mapping[str, int],
    needed: Mapping[str, Sequence[str]] | None = None,
) -> None:
    """Swap the staged tables in and enter them in the ledger, or leave everything as it was.

    Rows are counted where they are staged: as many as were sent, and some in every period that
    ``needed`` names for a table. Then the next version of every table is claimed, which fails if
    another writer has changed it since ``base``.
    """
    ledger_path = run.path("ledger")
    try:
        counted = _together(spark, [w.staged.counts for w in writes])
        for write, counts in zip(writes, counted):
            if sum(counts.values()) != write.staged.rows:
                raise RuntimeError(
                    f"{', '.join(write.names.values())}: {write.staged.rows} row(s) sent, "
                    f"{sum(counts.values())} stored"
                )
            for name in write.names.values():
                found = write.rows_of(counts, name)
                short = {p: 0 for p in (needed or {}).get(name, ()) if not found.get(p)}
                if short:
                    raise ValueError(
                        f"{name}: expected at least 1 row(s) per period, found {short}"
                    )
        versions = {
            name: ledger.claim_version(spark, ledger_path, name, run.periods, base[name])
            for write in writes
            for name in write.names.values()
        }
    except Exception:
        _discard(writes)
        raise
    _together(spark, [w.staged.swap for w in writes])
    entries = [
        ledger.Entry(
            name,
            period,
            "replace",
            write.rows_of(counts, name).get(period, 0),
            run.run_ts,
            versions[name],
        )
        for write, counts in zip(writes, counted)
        for name in write.names.values()
        for period in run.periods
    ]
    ledger.append_ledger(spark, ledger_path, entries)


def _base(spark: SparkSession, run: Settings, names: Sequence[str]) -> dict[str, int]:
    return ledger.current_versions(spark, run.path("ledger"), names)


def ingest(
    spark: SparkSession,
    run: Settings,
    premium_path: str,
    claim_path: str,
    period_dirs: bool = False,
) -> None:
    """Files to bronze. One period per call, or many when files lie in ``period=`` directories.

    Each source is read once. Both need rows in every period of the run, or nothing is changed at
    all; periods that may be cleared are named in ``Settings.may_be_empty``. With the rule
    ``PERIOD_NULL`` rows without a period come along, to be quarantined. With
    ``Settings.quarantine_lines`` lines with too few or too many fields go to tables of their own.
    """
    if not period_dirs and len(run.periods) != 1:
        raise ValueError("files without period directories hold exactly one period")
    sources = {
        "premium": (premium_path, schemas.PREMIUM_FILE, schemas.PREMIUM_LINES),
        "claim": (claim_path, schemas.CLAIM_FILE, schemas.CLAIM_LINES),
    }

    def write(name: str) -> _Write:
        path, file_schema, schema = sources[name]
        raw = read_delimited(
            spark,
            path,
            file_schema,
            encoding=run.encoding,
            period_dirs=period_dirs,
            keep_corrupt=run.quarantine_lines,
        )
        if period_dirs:
            wanted = F.col(schemas.PERIOD).isin(*run.periods)
            if run.null_periods:
                wanted = wanted | F.col(schemas.PERIOD).isNull()
            rows = stamp(raw, run.run_ts).where(wanted)
        else:
            rows = stamp(raw, run.run_ts, run.periods[0])
        line = F.col(CORRUPT) if run.quarantine_lines else F.lit(None).cast("string")
        rows = rows.withColumn(schemas.CORRUPT_LINE, line).select(*schema.names)
        table, lines = run.path(f"bronze/{name}"), run.path(f"bronze/{name}_lines")
        # Lines of an earlier run go even where they are not told apart any more.
        staged = tables.stage_outcomes(
            rows, table, run.stored_periods, schemas.CORRUPT_LINE, quarantine_path=lines
        )
        names = {tables.CLEAN: f"bronze/{name}"}
        if run.quarantine_lines:
            names[tables.QUARANTINED] = f"bronze/{name}_lines"
        return _Write(staged, names)

    base = _base(spark, run, [f"bronze/{n}{end}" for n in sources for end in ("", "_lines")])
    writes = _staged(spark, [partial(write, name) for name in sources])
    needed = [p for p in run.periods if p not in run.may_be_empty]
    _commit(spark, run, writes, base, {f"bronze/{name}": needed for name in sources})


def read_lines(spark: SparkSession, run: Settings, name: str) -> DataFrame:
    """The quarantined lines of ``premium`` or ``claim``, with the fields that were read of them."""
    schema = {"premium": schemas.PREMIUM_LINES, "claim": schemas.CLAIM_LINES}[name]
    return read_period(spark, run.path(f"bronze/{name}_lines"), schema, run.stored_periods)


def tagged_rows(
    premium: DataFrame,
    claim: DataFrame,
    regions: DataFrame,
    rules: Sequence[quality.Rule] = quality.RULES,
    alert_threshold: float = 2.0,
    repeated_claim_keys: bool = False,
    hot: Sequence[silver.HotKey] = (),
) -> DataFrame:
    """Typed premium and claims to joined, named, tagged and flagged rows."""
    joined = silver.join_claims(
        premium, claim, repeated_claim_keys=repeated_claim_keys, hot=hot
    )
    named = silver.enrich(joined, regions)
    return quality.flag(quality.tag(named, rules), [quality.high_ratio(alert_threshold)])


def refine(spark: SparkSession, run: Settings, regions: DataFrame) -> None:
    """Bronze to silver: clean and quarantined rows, written in one pass."""
    premium = silver.type_premium(
        read_period(spark, run.path("bronze/premium"), schemas.BRONZE_PREMIUM, run.stored_periods),
        run.strict_numbers,
    )
    claim = silver.type_claim(
        read_period(spark, run.path("bronze/claim"), schemas.BRONZE_CLAIM, run.periods),
        run.strict_numbers,
        keep_malformed=quality.CLAIM_MALFORMED in run.rules,
    )
    hot = []
    if run.hot_claim_share is not None and not run.repeated_claim_keys:
        hot = silver.hot_claim_keys(claim, share=run.hot_claim_share)
    if quality.CLAIM_REPEATED in run.rules:
        claim = silver.with_claim_copies(claim)
    tagged = tagged_rows(
        premium,
        claim,
        silver.require_unique(regions),
        run.rules,
        run.alert_threshold,
        run.repeated_claim_keys,
        hot,
    )
    ready = silver.processed(tagged, run.run_ts).select(*schemas.QUARANTINE.names)
    names = {outcome: f"silver/{outcome}" for outcome in (tables.CLEAN, tables.QUARANTINED)}
    base = _base(spark, run, list(names.values()))
    staged = tables.stage_outcomes(
        ready, run.path("silver"), run.stored_periods, rebalance=run.compact
    )
    _commit(spark, run, [_Write(staged, names)], base)


def publish(spark: SparkSession, run: Settings) -> None:
    """Silver to the four marts.

    One scan reduces silver to totals per segment where it is read, and rolls these up to the grain
    of every mart; the marts are projections of that. Only the alert list reads silver once more:
    its rows above the threshold.
    """
    clean = read_silver(spark, run, tables.CLEAN)
    high, watch = run.loss_threshold, run.watch_threshold
    outputs = {
        "by_region": (schemas.GOLD_BY_REGION, lambda t: marts.region_mart(t, high, watch)),
        "by_coverage": (schemas.GOLD_BY_COVERAGE, marts.coverage_mart),
        "summary": (schemas.GOLD_SUMMARY, marts.summary_mart),
    }
    base = _base(spark, run, [f"gold/{name}" for name in (*outputs, "alerts")])

    def write(name: str, mart: DataFrame, schema: StructType) -> _Write:
        rows = silver.processed(mart, run.run_ts).select(*schema.names)
        staged = tables.stage_periods(rows, run.path(f"gold/{name}"), run.periods)
        return _Write(staged, {None: f"gold/{name}"})

    totals = marts.rolled_up(marts.totals(clean, marts.SEGMENT, high))
    by = (marts.GRAIN, schemas.PERIOD)
    rolled = tables.stage(totals, run.path("gold/totals"), by, {})
    try:
        stored = spark.read.schema(totals.schema).parquet(rolled.folder)
        actions = [
            partial(write, name, mart(marts.of_grain(stored, name)), schema)
            for name, (schema, mart) in outputs.items()
        ]
        actions.append(partial(write, "alerts", marts.alerts(clean, high), schemas.GOLD_ALERTS))
        writes = _staged(spark, actions)
    finally:
        rolled.discard()
    _commit(spark, run, writes, base)


def run_all(
    spark: SparkSession,
    run: Settings,
    premium_path: str,
    claim_path: str,
    regions: DataFrame,
    period_dirs: bool = False,
) -> None:
    ingest(spark, run, premium_path, claim_path, period_dirs)
    refine(spark, run, regions)
    publish(spark, run)
