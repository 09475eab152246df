"""Run the layers from the command line: ``spark-submit`` this package or ``python -m lossmill``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossmill import schemas
from lossmill.operators import marts, quality
from lossmill.plans import medallion
from lossmill.sinks import last_operations, reconcile
from lossmill.sources import read_delimited, read_period, read_regions
from lossmill.sources.delimited import FILE_ENCODING


OPTIONAL_RULES = {
    rule.code: rule
    for rule in (quality.PERIOD_NULL, quality.CLAIM_MALFORMED, quality.CLAIM_REPEATED)
}


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser("lossmill", description=__doc__)
    parser.add_argument("step", choices=("ingest", "refine", "publish", "all"))
    parser.add_argument("--base", required=True, help="folder of the tables")
    parser.add_argument("--period", required=True, action="append", dest="periods")
    parser.add_argument("--premium", help="premium files (ingest)")
    parser.add_argument("--claim", help="claim files (ingest)")
    parser.add_argument("--regions", help="region file (refine)")
    parser.add_argument("--period-dirs", action="store_true", help="files lie in period= folders")
    parser.add_argument("--encoding", default=FILE_ENCODING)
    run = medallion.Settings
    for name in ("loss", "watch", "alert"):
        default = getattr(run, f"{name}_threshold")
        parser.add_argument(f"--{name}-threshold", type=float, default=default)
    parser.add_argument("--strict-numbers", action="store_true", help="plain digits only")
    parser.add_argument("--rule", choices=sorted(OPTIONAL_RULES), action="append", default=[])
    parser.add_argument("--compact", action="store_true", help="fewer, evenly sized silver files")
    parser.add_argument("--may-be-empty", metavar="PERIOD", action="append", default=[])
    parser.add_argument("--repeated-claim-keys", action="store_true")
    parser.add_argument(
        "--hot-claim-share",
        type=float,
        default=run.hot_claim_share,
        help="claim keys with more of all claims are joined in parts; 0 looks for none",
    )
    parser.add_argument(
        "--quarantine-lines", action="store_true", help="keep malformed lines out of bronze"
    )
    given = parser.parse_args(argv)
    needed = {"ingest": ("premium", "claim"), "refine": ("regions",), "publish": ()}
    steps = needed if given.step == "all" else (given.step,)
    for option in (option for step in steps for option in needed[step]):
        if getattr(given, option) is None:
            parser.error(f"{given.step} needs --{option}")
    return given


def _settings(given: argparse.Namespace) -> medallion.Settings:
    return medallion.Settings(
        given.base,
        tuple(given.periods),
        loss_threshold=given.loss_threshold,
        watch_threshold=given.watch_threshold,
        alert_threshold=given.alert_threshold,
        encoding=given.encoding,
        strict_numbers=given.strict_numbers,
        rules=quality.RULES + tuple(OPTIONAL_RULES[code] for code in given.rule),
        compact=given.compact,
        may_be_empty=tuple(given.may_be_empty),
        repeated_claim_keys=given.repeated_claim_keys,
        hot_claim_share=given.hot_claim_share or None,
        quarantine_lines=given.quarantine_lines,
    )


def ingest_reports(
    spark: SparkSession,
    run: medallion.Settings,
    premium_path: str,
    claim_path: str,
    period_dirs: bool = False,
) -> dict[str, DataFrame]:
    """What an ingest is looked over by: source against written rows, coverages, regions."""
    files = {
        "premium": (premium_path, schemas.PREMIUM_FILE, schemas.BRONZE_PREMIUM),
        "claim": (claim_path, schemas.CLAIM_FILE, schemas.BRONZE_CLAIM),
    }
    layers, found = {}, {}
    for name, (path, file_schema, schema) in files.items():
        raw = read_delimited(
            spark, path, file_schema, encoding=run.encoding, period_dirs=period_dirs
        )
        if period_dirs:
            raw = raw.where(F.col(schemas.PERIOD).isin(*run.periods))
        else:
            raw = raw.withColumn(schemas.PERIOD, F.lit(run.periods[0]))
        layers[f"source_{name}"] = raw
        layers[f"bronze_{name}"] = read_period(
            spark, run.path(f"bronze/{name}"), schema, run.periods
        )
        found[f"{name} coverages"] = marts.frequency(layers[f"bronze_{name}"], "coverage")
        if run.quarantine_lines:
            layers[f"bronze_{name}_lines"] = medallion.read_lines(spark, run, name)
    regions = marts.distinct_rows(layers["bronze_premium"], ["region_code", "region_name"])
    return {"source and written rows": reconcile(layers)} | found | {"regions": regions}


def reports(spark: SparkSession, run: medallion.Settings, step: str) -> dict[str, DataFrame]:
    """What a run is looked over by: counts, quality, the leading rows of each mart."""
    found = {}
    if step in ("refine", "all"):
        tagged = medallion.read_tagged(spark, run)
        found["rows per layer"] = reconcile(medallion.stored_layers(spark, run))
        found["quality"] = quality.quality_report(tagged, ["period"])
        found["quarantined rows"] = quality.quarantine_breakdown(tagged)
    if step in ("publish", "all"):
        region = read_period(spark, run.path("gold/by_region"), schemas.GOLD_BY_REGION, run.periods)
        alert = read_period(spark, run.path("gold/alerts"), schemas.GOLD_ALERTS, run.periods)
        found["portfolio"] = read_period(
            spark, run.path("gold/summary"), schemas.GOLD_SUMMARY, run.periods
        )
        found["top regions"] = marts.top_n(region, "loss_ratio", 10, ["region_code", "period"])
        found["risk tiers"] = marts.frequency(region, "risk_tier")
        found["top alerts"] = marts.top_n(alert, "loss_ratio", 20, list(schemas.SEGMENT_KEYS))
    found["last operations"] = last_operations(spark, run.path("ledger"), 8)
    return found


def main(argv: Sequence[str] | None = None) -> None:
    given = _arguments(argv)
    spark = SparkSession.builder.appName("lossmill").getOrCreate()
    run = _settings(given)
    found = {}
    if given.step in ("ingest", "all"):
        medallion.ingest(spark, run, given.premium, given.claim, given.period_dirs)
        found = ingest_reports(spark, run, given.premium, given.claim, given.period_dirs)
    if given.step in ("refine", "all"):
        regions = read_regions(spark, given.regions, encoding=given.encoding)
        medallion.refine(spark, run, regions)
    if given.step in ("publish", "all"):
        medallion.publish(spark, run)
    for title, report in (found | reports(spark, run, given.step)).items():
        print(title)
        report.show(truncate=False)


if __name__ == "__main__":
    main()
