"""The registered queries: each operator over the star-schema binding."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossmill import schemas
from lossmill.functions import comma_decimal, loss_ratio, risk_tier, to_long
from lossmill.operators import distincts, marts, quality, silver, trends
from lossmill.operators.bronze import stamp
from lossmill.plans import medallion
from lossmill.sinks import append_ledger, last_operations, reconcile, scratch_path
from lossmill.sinks.ledger import Entry
from lossmill.sinks.tables import CLEAN, period_counts, replace_period, replace_periods
from lossmill.sources import (
    read_delimited,
    read_period,
    read_regions,
    read_table,
    rows_per_period,
)
from lossmill.sources.delimited import FILE_ENCODING, FILE_FORMAT
from lossmill.sources.star import Star, write_files

Query = Callable[[SparkSession, str], DataFrame]

KEYS = list(schemas.SEGMENT_KEYS)
SCANNED_PERIODS = ("1996S1", "1998S2")
CORRECTED_PERIOD = "1997S1"
MISSING_PERIOD = "1995S2"
ABSENT_PERIOD = "1900S1"


def _unstamped(raw: DataFrame) -> DataFrame:
    return raw.withColumn("ingested_at", F.lit(None).cast("timestamp"))


def _premium(tables: Star) -> DataFrame:
    return silver.type_premium(_unstamped(tables.premium)).drop("premium_ingested_at")


def _claim(tables: Star) -> DataFrame:
    return silver.type_claim(_unstamped(tables.claim))


def _regions(tables: Star) -> DataFrame:
    return tables.regions.withColumnsRenamed({"code": "dim_code", "name": "region_name"})


def _joined(tables: Star) -> DataFrame:
    return silver.join_claims(_premium(tables), _claim(tables))


def _tagged(tables: Star) -> DataFrame:
    return medallion.tagged_rows(_premium(tables), _claim(tables), _regions(tables))


def _clean(tables: Star) -> DataFrame:
    return quality.split(_tagged(tables))[0]


# Sources and sinks ------------------------------------------------------------------------------


def src_locale_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_files(Star(spark, sf_dir).premium, scratch_path(spark, "premium-files"))
    return read_delimited(spark, path, schemas.PREMIUM_FILE, period_dirs=True)


def src_region_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_files(Star(spark, sf_dir).regions, scratch_path(spark, "region-files"))
    return read_regions(spark, path)


def src_period_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "premium")
    tables = Star(spark, sf_dir)
    typed = _premium(tables)
    replace_periods(typed, path, tables.periods)
    return read_period(spark, path, typed.schema, SCANNED_PERIODS)


def src_period_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of both sources in every half-year, and in one that has no files."""
    tables = Star(spark, sf_dir)
    wanted = (*tables.periods, ABSENT_PERIOD)
    counts = [
        rows_per_period(df, wanted).select(F.lit(name).alias("source"), "period", "row_count")
        for name, df in (("premium", tables.premium), ("claim", tables.claim))
    ]
    return counts[0].unionByName(counts[1])


def _store_premium(spark: SparkSession, tables: Star) -> tuple[str, DataFrame]:
    """Every period of the raw premiums; the path and the stored table."""
    path = scratch_path(spark, "premium")
    replace_periods(tables.premium, path, tables.periods)
    return path, read_table(spark, path, tables.premium.schema)


def _correct_premium(spark: SparkSession, path: str, tables: Star) -> DataFrame:
    """One period once more, with fewer rows; the stored table after that."""
    corrected = tables.premium.where(
        (F.col("period") == CORRECTED_PERIOD) & (F.col("coverage") != "MACHINERY")
    )
    replace_period(corrected, path, CORRECTED_PERIOD)
    return read_table(spark, path, tables.premium.schema)


def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Star(spark, sf_dir)
    typed = _premium(tables)
    path = scratch_path(spark, "premium")
    replace_periods(typed, path, tables.periods)
    return read_table(spark, path, typed.schema)


def sink_replace_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Star(spark, sf_dir)
    path, _ = _store_premium(spark, tables)
    return _correct_premium(spark, path, tables)


def ledger_last_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs: every premium period, one corrected period, every claim period."""
    tables = Star(spark, sf_dir)
    ledger = scratch_path(spark, "ledger")

    def enter(day: int, name: str, stored: DataFrame) -> None:
        run_ts = datetime(2020, 1, day, tzinfo=timezone.utc)
        counts = period_counts(stored).collect()
        append_ledger(
            spark, ledger, [Entry(name, period, "replace", rows, run_ts) for period, rows in counts]
        )

    path, stored = _store_premium(spark, tables)
    enter(1, "premium", stored)
    stored = _correct_premium(spark, path, tables)
    enter(2, "premium", stored.where(F.col("period") == CORRECTED_PERIOD))
    claim_path = scratch_path(spark, "claim")
    replace_periods(tables.claim, claim_path, tables.periods)
    enter(3, "claim", read_table(spark, claim_path, tables.claim.schema))
    return last_operations(spark, ledger, 5).drop("run_ts")


def _broken_lines(tables: Star, spark: SparkSession) -> tuple[str, str]:
    """Files of both sources in which the lines of one coverage lack their last field and those of
    another have one too many."""

    def write(frame: DataFrame, name: str) -> str:
        fields = [c for c in frame.columns if c != "period"]
        short = F.when(F.col("coverage") != "MACHINERY", F.coalesce(fields[-1], F.lit("")))
        long = F.when(F.col("coverage") == "BUILDING", F.lit("x"))
        given = [F.coalesce(c, F.lit("")) for c in fields[:-1]]
        line = F.concat_ws(FILE_FORMAT["sep"], *given, short, long)
        path = scratch_path(spark, name)
        header = FILE_FORMAT["sep"].join(fields)
        lines = frame.select(line.alias(header), "period").write.partitionBy("period")
        lines.options(header="true", sep="\u0001", quote="", encoding=FILE_ENCODING).csv(path)
        return path

    return write(tables.premium, "premium-lines"), write(tables.claim, "claim-lines")


def _ingest_broken(spark: SparkSession, sf_dir: str) -> tuple[medallion.Settings, Star]:
    tables = Star(spark, sf_dir)
    run = medallion.Settings(
        scratch_path(spark, "line-layers"), tables.periods, quarantine_lines=True
    )
    medallion.ingest(spark, run, *_broken_lines(tables, spark), period_dirs=True)
    return run, tables


def bronze_malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that bronze keeps apart, as they stand in the files."""
    run, _ = _ingest_broken(spark, sf_dir)
    found = [
        medallion.read_lines(spark, run, name).select(
            F.lit(name).alias("source"), "period", "region_code", "coverage", schemas.CORRUPT_LINE
        )
        for name in ("premium", "claim")
    ]
    return found[0].unionByName(found[1])


def recon_malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per coverage of bronze and silver: none of the lines that are kept apart."""
    run, tables = _ingest_broken(spark, sf_dir)
    medallion.refine(spark, run, _regions(tables))
    layers = medallion.stored_layers(spark, run)
    rows = [df.select(F.lit(name).alias("layer"), "coverage") for name, df in layers.items()]
    everything = reduce(DataFrame.unionByName, rows)
    return everything.groupBy("layer", "coverage").agg(F.count(F.lit(1)).alias("row_count"))


def recon_layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to bronze to silver for all periods, then the rows of each stored layer."""
    tables = Star(spark, sf_dir)
    premium = write_files(tables.premium, scratch_path(spark, "premium-files"))
    claim = write_files(tables.claim, scratch_path(spark, "claim-files"))
    run = medallion.Settings(scratch_path(spark, "layers"), tables.periods)
    medallion.ingest(spark, run, premium, claim, period_dirs=True)
    medallion.refine(spark, run, _regions(tables))
    stored = medallion.stored_layers(spark, run)
    premium_file = read_delimited(spark, premium, schemas.PREMIUM_FILE, period_dirs=True)
    claim_file = read_delimited(spark, claim, schemas.CLAIM_FILE, period_dirs=True)
    return reconcile({"source_premium": premium_file, "source_claim": claim_file} | stored)


def bronze_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_files(Star(spark, sf_dir).claim, scratch_path(spark, "claim-files"))
    raw = read_delimited(spark, path, schemas.CLAIM_FILE, period_dirs=True)
    stamped = stamp(raw, datetime(2020, 6, 1, tzinfo=timezone.utc))
    return stamped.select(
        *raw.columns,
        F.date_format("ingested_at", "yyyy").alias("ingest_year"),
        F.regexp_extract("source_file", "period=([^/]+)/", 1).alias("file_period"),
    )


# Casts and row expressions ----------------------------------------------------------------------


def cast_comma_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Star(spark, sf_dir).premium.select(
        *KEYS, "premium", comma_decimal("premium").alias("premium_value")
    )


def cast_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Star(spark, sf_dir).claim.select(
        *KEYS, to_long("claim_count").alias("claim_count"), to_long("coverage").alias("no_number")
    )


def cast_bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = Star(spark, sf_dir).claim
    return silver.cast_columns(raw, decimals=["claim_amount"], longs=["claim_count"])


def silver_typed_premium(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _premium(Star(spark, sf_dir))


def silver_typed_claim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _claim(Star(spark, sf_dir)).drop("claim_ingested_at")


def silver_null_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(Star(spark, sf_dir)).select(*KEYS, "claim_count", "claim_amount")


def silver_loss_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(Star(spark, sf_dir)).select(*KEYS, "premium", "claim_amount", "loss_ratio")


def ratio_fn_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratios = [loss_ratio("claim_amount", "premium", n).alias(f"ratio_{n}") for n in (0, 2, 6)]
    return _joined(Star(spark, sf_dir)).select(*KEYS, *ratios)


def row_risk_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(Star(spark, sf_dir)).select(
        *KEYS, "loss_ratio", risk_tier("loss_ratio").alias("risk_tier")
    )


# Joins and quality ------------------------------------------------------------------------------


def silver_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(Star(spark, sf_dir))


HOT_KEY = ("1996S1", "01", "BUILDING")


def silver_join_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of all claims on one key, which is found and dealt in parts."""
    tables = Star(spark, sf_dir)
    moved = F.col("claim_count") % 3 == 0
    changed = {
        f"claim_{k}": F.when(moved, v).otherwise(F.col(f"claim_{k}")) for k, v in zip(KEYS, HOT_KEY)
    }
    claim = _claim(tables).withColumns(changed)
    hot = silver.hot_claim_keys(claim)
    return silver.join_claims(_premium(tables), claim, hot=hot)


def silver_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Star(spark, sf_dir)
    return silver.enrich(_joined(tables), _regions(tables))


def dq_unknown_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Star(spark, sf_dir)
    unknown = silver.unknown_regions(_premium(tables), _regions(tables))
    return unknown.select(*KEYS, "premium")


def dq_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(Star(spark, sf_dir)).select(*KEYS, "premium", "claim_amount", quality.REASON)


def dq_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(Star(spark, sf_dir))


def dq_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.split(_tagged(Star(spark, sf_dir)))[1]


def dq_alert_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(Star(spark, sf_dir)).select(*KEYS, "loss_ratio", "high_ratio_alert")


def dq_alert_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Star(spark, sf_dir)
    tagged = medallion.tagged_rows(
        _premium(tables), _claim(tables), _regions(tables), alert_threshold=1.5
    )
    return tagged.select(*KEYS, "loss_ratio", "high_ratio_alert")


def _failing(tables: Star, rule: quality.Rule, claim: DataFrame) -> DataFrame:
    """Rows that an optional rule alone quarantines."""
    tagged = medallion.tagged_rows(_premium(tables), claim, _regions(tables), [rule])
    failed = quality.split(tagged)[1]
    return failed.select(*KEYS, "claim_amount", quality.REASON)


def dq_claim_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Star(spark, sf_dir)
    claim = silver.type_claim(_unstamped(tables.claim), keep_malformed=True)
    return _failing(tables, quality.CLAIM_MALFORMED, claim)


def dq_claim_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Star(spark, sf_dir)
    return _failing(tables, quality.CLAIM_REPEATED, silver.with_claim_copies(_claim(tables)))


def dq_period_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one coverage lose their period: they match no claim and are quarantined for it."""
    tables = Star(spark, sf_dir)
    period = F.when(F.col("coverage") != "FURNITURE", F.col("period"))
    premium = _premium(tables).withColumn("period", period)
    rules = (quality.PERIOD_NULL, *quality.RULES)
    tagged = medallion.tagged_rows(premium, _claim(tables), _regions(tables), rules)
    return quality.split(tagged)[1].select(*KEYS, "premium", "claim_amount", quality.REASON)


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_tagged(Star(spark, sf_dir)))


def dq_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quarantine_breakdown(_tagged(Star(spark, sf_dir)))


# Marts and reports ------------------------------------------------------------------------------


def gold_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = marts.by_region(_clean(Star(spark, sf_dir)))
    return marts.ranked(mart, "loss_ratio", ["region_code", "period"])


def gold_by_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = marts.by_coverage(_clean(Star(spark, sf_dir)))
    return marts.ranked(mart, "loss_ratio", ["coverage", "period"])


def gold_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.ranked(marts.alerts(_clean(Star(spark, sf_dir))), "loss_ratio", KEYS)


def gold_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.summary(_clean(Star(spark, sf_dir)))


def silver_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean rows with the instant of their run."""
    run_ts = datetime(2021, 3, 4, 5, 6, 7, tzinfo=timezone.utc)
    rows = silver.processed(_clean(Star(spark, sf_dir)), run_ts)
    instant = F.unix_timestamp("processed_at").alias("processed_second")
    return rows.select(*KEYS, "loss_ratio", instant)


def gold_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to marts with thresholds and periods other than the default ones."""
    tables = Star(spark, sf_dir)
    premium = write_files(tables.premium, scratch_path(spark, "premium-files"))
    claim = write_files(tables.claim, scratch_path(spark, "claim-files"))
    run = medallion.Settings(
        scratch_path(spark, "parameter-layers"),
        SCANNED_PERIODS,
        loss_threshold=0.8,
        watch_threshold=0.6,
        alert_threshold=0.9,
    )
    medallion.run_all(spark, run, premium, claim, _regions(tables), period_dirs=True)
    silver_rows = medallion.read_silver(spark, run, CLEAN).groupBy("period")
    silver_rows = silver_rows.agg(F.count_if("high_ratio_alert").alias("alerted_rows"))
    tiers = read_table(spark, run.path("gold/by_region"), schemas.GOLD_BY_REGION)
    tiers = tiers.groupBy("period").agg(
        *(F.count_if(F.col("risk_tier") == t).alias(t.lower()) for t in ("HIGH", "WATCH", "HEALTHY"))
    )
    total = read_table(spark, run.path("gold/summary"), schemas.GOLD_SUMMARY)
    total = total.select("period", "loss_making_segments")
    return total.join(tiers, "period").join(silver_rows, "period")


def gold_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sums of three marts out of one scan and one aggregation by segment."""
    totals = marts.totals(_clean(Star(spark, sf_dir)), marts.SEGMENT)
    return marts.sums_of_grains(marts.rolled_up(totals))


def distinct_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = Star(spark, sf_dir).premium
    return marts.distinct_rows(raw, ["region_code", "region_name"])


def distinct_coverages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.distinct_rows(_clean(Star(spark, sf_dir)), ["coverage"])


def count_distinct_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.count_distinct(_clean(Star(spark, sf_dir)), "region_code", "regions")


def top_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = marts.by_region(_clean(Star(spark, sf_dir)))
    return marts.top_n(mart, "loss_ratio", 10, ["region_code", "period"])


def top_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _clean(Star(spark, sf_dir)).select(
        *KEYS, "region_name", "premium", "claim_amount", "loss_ratio", "high_ratio_alert"
    )
    return marts.top_n(rows, "loss_ratio", 10, KEYS)


def top_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = marts.alerts(_clean(Star(spark, sf_dir))).select(
        *KEYS, "region_name", "loss_ratio", "loss_amount"
    )
    return marts.top_n(rows, "loss_ratio", 20, KEYS)


def freq_premium_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.frequency(Star(spark, sf_dir).premium, "coverage")


def freq_claim_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.frequency(Star(spark, sf_dir).claim, "coverage")


def freq_risk_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.frequency(marts.by_region(_clean(Star(spark, sf_dir))), "risk_tier")


def trend_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.trend_by_region(marts.by_region(_clean(Star(spark, sf_dir))))


def calendar_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With one half-year taken out, so that there is a gap."""
    clean = _clean(Star(spark, sf_dir)).where(F.col("period") != MISSING_PERIOD)
    return trends.calendar_trend(marts.by_region(clean))


def _distinct_parts(spark: SparkSession, parts: DataFrame, label: str) -> DataFrame:
    """Stored per period and read back, as later runs would find them."""
    path = scratch_path(spark, label)
    periods = [r.period for r in parts.select("period").distinct().collect()]
    replace_periods(parts, path, periods)
    return read_table(spark, path, parts.schema)


SKETCHED = ("region_code", "coverage", "premium", "claim_count")


def sketched_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact distinct counts, and whether the merged sketches of all periods come close to them."""
    clean = _clean(Star(spark, sf_dir))
    stored = _distinct_parts(spark, distincts.sketches(clean, SKETCHED), "sketches")
    exact = clean.agg(*(F.count_distinct(c).alias(c) for c in SKETCHED))
    pairs = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_distinct")) for c in SKETCHED))
    off = F.abs(F.col("approx_distinct") - F.col("n_distinct"))
    bound = F.col("n_distinct") * distincts.relative_error()
    joined = exact.select(F.inline(pairs)).join(distincts.estimates(stored), "column_name")
    return joined.select("column_name", "n_distinct", (off <= bound).alias("within_bound"))


def distinct_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct segments of claims from the first half-year to each one, from bitmaps per period."""
    claim = _claim(Star(spark, sf_dir))
    named = F.concat_ws("|", "claim_region_code", "claim_coverage", "claim_count")
    rows = claim.select(F.col("claim_period").alias("period"), named.alias("segment"))
    numbers = distincts.numbered(rows.select(F.col("segment").alias("value")))
    stored = _distinct_parts(spark, distincts.bitmaps(rows, "segment", numbers), "bitmaps")
    ends = stored.select(F.col("period").alias("to_period")).distinct()
    upto = stored.join(ends, F.col("period") <= F.col("to_period"))
    return distincts.count_of(upto, ["to_period"])


def exposure_weighted_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.exposure_weighted_ratio(_clean(Star(spark, sf_dir)))


def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The approximate distinct count is left out: a sketch has no equal in SQL."""
    columns = ["region_code", "coverage", "period", "premium", "claim_count", "failure_reason"]
    return trends.column_profile(_tagged(Star(spark, sf_dir)), columns).drop("approx_distinct")


def orphan_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Star(spark, sf_dir)
    orphans = silver.orphan_claims(_premium(tables), _claim(tables))
    return orphans.drop("claim_ingested_at")


QUERIES: dict[str, Query] = {
    "src_locale_csv": src_locale_csv,
    "src_region_dim": src_region_dim,
    "src_period_scan": src_period_scan,
    "src_period_counts": src_period_counts,
    "sink_roundtrip": sink_roundtrip,
    "sink_replace_partition": sink_replace_partition,
    "ledger_last_n": ledger_last_n,
    "bronze_malformed_lines": bronze_malformed_lines,
    "recon_malformed_lines": recon_malformed_lines,
    "recon_layer_counts": recon_layer_counts,
    "bronze_stamp": bronze_stamp,
    "cast_comma_decimal": cast_comma_decimal,
    "cast_long": cast_long,
    "cast_bulk": cast_bulk,
    "silver_typed_premium": silver_typed_premium,
    "silver_typed_claim": silver_typed_claim,
    "silver_null_fill": silver_null_fill,
    "silver_loss_ratio": silver_loss_ratio,
    "ratio_fn_decimals": ratio_fn_decimals,
    "risk_tier": row_risk_tier,
    "silver_join": silver_join,
    "silver_join_hot": silver_join_hot,
    "silver_enrich": silver_enrich,
    "dq_unknown_region": dq_unknown_region,
    "dq_tag": dq_tag,
    "dq_clean": dq_clean,
    "dq_quarantine": dq_quarantine,
    "dq_alert_flag": dq_alert_flag,
    "dq_alert_threshold": dq_alert_threshold,
    "dq_claim_malformed": dq_claim_malformed,
    "dq_claim_repeated": dq_claim_repeated,
    "dq_period_null": dq_period_null,
    "dq_report": dq_report,
    "dq_breakdown": dq_breakdown,
    "gold_by_region": gold_by_region,
    "gold_by_coverage": gold_by_coverage,
    "gold_alerts": gold_alerts,
    "gold_summary": gold_summary,
    "gold_rollup": gold_rollup,
    "gold_parameters": gold_parameters,
    "silver_processed": silver_processed,
    "distinct_regions": distinct_regions,
    "distinct_coverages": distinct_coverages,
    "count_distinct_regions": count_distinct_regions,
    "top_regions": top_regions,
    "top_segments": top_segments,
    "top_alerts": top_alerts,
    "freq_premium_coverage": freq_premium_coverage,
    "freq_claim_coverage": freq_claim_coverage,
    "freq_risk_tier": freq_risk_tier,
    "trend_by_region": trend_by_region,
    "calendar_trend": calendar_trend,
    "sketched_distinct": sketched_distinct,
    "distinct_to_date": distinct_to_date,
    "exposure_weighted_ratio": exposure_weighted_ratio,
    "column_profile": column_profile,
    "orphan_claims": orphan_claims,
}
