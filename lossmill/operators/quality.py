"""Rules that quarantine rows, alerts that only flag them, and reports on both."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossmill.functions import round_snap

REASON = "failure_reason"


@dataclass(frozen=True)
class Rule:
    """A SQL condition that is true for a failing row, and the code written for it."""

    code: str
    fails_when: str
    text: str

    def failure(self) -> Column:
        return F.when(F.expr(self.fails_when), F.lit(self.code))


@dataclass(frozen=True)
class AlertRule:
    """A SQL condition that sets a boolean column and keeps the row."""

    column: str
    raised_when: str
    text: str

    def flag(self) -> Column:
        return F.coalesce(F.expr(self.raised_when), F.lit(False))


# In order of precedence: a row gets the code of the first rule it fails.
RULES = (
    Rule("region_null", "region_code is null", "region code is missing"),
    Rule("premium_null", "premium is null", "premium is missing or did not parse"),
    Rule("premium_not_positive", "premium <= 0", "no ratio exists on a premium of zero or less"),
    Rule("claim_negative", "claim_amount < 0", "a claim amount cannot be negative"),
    Rule("region_unknown", "region_name is null", "region code is not in the dimension"),
)
# Optional. The claim rules need the columns that `type_claim(keep_malformed=True)` and
# `with_claim_copies` add.
PERIOD_NULL = Rule("period_null", "period is null", "period is missing")
CLAIM_MALFORMED = Rule("claim_malformed", "claim_malformed", "claim text did not parse")
CLAIM_REPEATED = Rule("claim_repeated", "claim_copies > 1", "several claim rows for one segment")


def high_ratio(threshold: float = 2.0) -> AlertRule:
    return AlertRule("high_ratio_alert", f"loss_ratio > {threshold!r}", "unusually high, verify")


def tag(df: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Add the code of the first failing rule; null means clean."""
    none = F.lit(None).cast("string")
    return df.withColumn(REASON, F.coalesce(none, *(rule.failure() for rule in rules)))


def flag(df: DataFrame, alerts: Iterable[AlertRule] | None = None) -> DataFrame:
    """Add one boolean column per alert; a null condition is false."""
    chosen = (high_ratio(),) if alerts is None else alerts
    return df.withColumns({a.column: a.flag() for a in chosen})


def split(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean rows without the reason column, and quarantined rows with it."""
    reason = F.col(REASON)
    return tagged.where(reason.isNull()).drop(REASON), tagged.where(reason.isNotNull())


def quality_report(tagged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Total, clean and quarantined rows and the pass rate in percent, in one pass.

    One row for the whole frame (also for an empty one, with a rate of zero), or one per value of
    ``by``.
    """
    clean = F.count_if(F.col(REASON).isNull())
    total = F.count(F.lit(1))
    counts = tagged.groupBy(*by).agg(
        total.alias("total_rows"),
        clean.alias("clean_rows"),
        F.count(REASON).alias("quarantined_rows"),
    )
    rate = F.try_divide(F.col("clean_rows") * 100.0, F.col("total_rows"))
    return counts.withColumn("pass_rate_pct", F.coalesce(round_snap(rate, 1), F.lit(0.0)))


def quarantine_breakdown(tagged: DataFrame) -> DataFrame:
    """Quarantined rows per reason, most frequent first."""
    failed = tagged.where(F.col(REASON).isNotNull())
    return failed.groupBy(REASON).agg(F.count(F.lit(1)).alias("row_count")).orderBy(
        F.desc("row_count"), REASON
    )
