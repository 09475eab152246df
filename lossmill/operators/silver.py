"""Typing, the premium-claim join and the region lookup."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossmill.functions import comma_decimal, is_malformed, loss_ratio, to_long
from lossmill.schemas import SEGMENT_KEYS


def cast_columns(
    df: DataFrame, decimals: Iterable[str] = (), longs: Iterable[str] = (), strict: bool = False
) -> DataFrame:
    """Type many text columns in one projection."""
    casts = {c: comma_decimal(c, strict) for c in decimals} | {c: to_long(c) for c in longs}
    return df.withColumns(casts) if casts else df


def type_premium(bronze: DataFrame, strict: bool = False) -> DataFrame:
    return bronze.select(
        "region_code",
        F.col("region_name").alias("premium_region_name"),
        "coverage",
        *(comma_decimal(c, strict).alias(c) for c in ("exposure", "premium", "avg_insured")),
        "period",
        F.col("ingested_at").alias("premium_ingested_at"),
    )


def type_claim(bronze: DataFrame, strict: bool = False, keep_malformed: bool = False) -> DataFrame:
    """Typed claims with their keys renamed, ready to join.

    The join fills missing amounts with zero, which also hides amounts that did not parse.
    ``keep_malformed`` adds ``claim_malformed``, taken before the join, for a rule to test.
    """
    amount = comma_decimal("claim_amount", strict)
    count = to_long("claim_count")
    columns = [
        F.col("region_code").alias("claim_region_code"),
        F.col("coverage").alias("claim_coverage"),
        count.alias("claim_count"),
        amount.alias("claim_amount"),
        F.col("period").alias("claim_period"),
        F.col("ingested_at").alias("claim_ingested_at"),
    ]
    if keep_malformed:
        malformed = is_malformed("claim_amount", amount) | is_malformed("claim_count", count)
        columns.append(malformed.alias("claim_malformed"))
    return bronze.select(*columns)


def fill_claims(df: DataFrame) -> DataFrame:
    """No claims is zero claims."""
    return df.withColumns(
        {
            "claim_count": F.coalesce("claim_count", F.lit(0).cast("bigint")),
            "claim_amount": F.coalesce("claim_amount", F.lit(0.0)),
        }
    )


def add_loss_ratio(df: DataFrame) -> DataFrame:
    return df.withColumn("loss_ratio", loss_ratio("claim_amount", "premium"))


def _same_keys(keys: Iterable[str]) -> Column:
    matches = [F.col(k) == F.col(f"claim_{k}") for k in keys]
    condition = matches[0]
    for match in matches[1:]:
        condition = condition & match
    return condition


@dataclass(frozen=True)
class HotKey:
    """A claim key that very many rows share, and into how many parts they are dealt."""

    key: str
    parts: int


def _key_text(columns: Iterable[str]) -> Column:
    """The values of a key as one text; null where one of them is, for that matches nothing."""
    columns = list(columns)
    known = F.lit(True)
    for c in columns:
        known = known & F.col(c).isNotNull()
    named = F.struct(*(F.col(c).cast("string").alias(f"k{i}") for i, c in enumerate(columns)))
    return F.when(known, F.to_json(named))


def hot_claim_keys(
    claim: DataFrame, keys: Iterable[str] = SEGMENT_KEYS, share: float = 0.02
) -> list[HotKey]:
    """Claim keys that hold more than ``share`` of all claim rows, 1 / ``share`` at most.

    Found by sketches of frequent items: each task keeps a bounded number of counters, the sketches
    are merged and nothing is shuffled by key. Only the key columns are read. Many more keys are
    tracked than can be hot, so counts are off by a small part of ``share`` at most.
    """
    if not 0 < share < 1:
        raise ValueError(f"not a share: {share}")
    most = math.ceil(1 / share)
    tracked = 1 << math.ceil(math.log2(64 * most))
    text = _key_text(f"claim_{k}" for k in keys)
    found = claim.select(text.alias("key")).agg(
        F.call_function("approx_top_k", F.col("key"), F.lit(most), F.lit(tracked)).alias("top"),
        F.count(F.lit(1)).alias("n"),
    )
    row = found.first()
    each = max(1.0, share * row["n"])
    return [
        HotKey(item["item"], math.ceil(item["count"] / each))
        for item in row["top"] or []
        if item["item"] is not None and item["count"] > each
    ]


def join_claims(
    premium: DataFrame,
    claim: DataFrame,
    keys: Iterable[str] = SEGMENT_KEYS,
    repeated_claim_keys: bool = False,
    hot: Sequence[HotKey] = (),
) -> DataFrame:
    """Every premium row with its claims, zeros where there are none, and the row ratio.

    Null keys match nothing. Neither side carries a hint: claims within Spark's broadcast threshold
    in bytes are joined where premium rows are read. Beyond it both sides are shuffled and adaptive
    execution splits a hot premium key.

    A shuffled left join cannot split a hot key of its right side. ``hot``, see
    ``hot_claim_keys``, names such keys: their claims are dealt into parts and their premium rows
    are repeated for every part, in the same join. With ``repeated_claim_keys`` the same rows come
    from an inner join, where either side may be split, and an anti join against the distinct claim
    keys, which are reduced before they are shuffled.
    """
    keys = tuple(keys)
    claim_keys = [f"claim_{k}" for k in keys]
    same = _same_keys(keys)
    if repeated_claim_keys:
        matched = premium.join(claim, same, "inner")
        alone = premium.join(claim.select(*claim_keys).distinct(), same, "left_anti")
        joined = matched.unionByName(alone, allowMissingColumns=True)
    elif hot:
        joined = _join_in_parts(premium, claim, keys, hot)
    else:
        joined = premium.join(claim, same, "left")
    joined = joined.drop(*claim_keys, "claim_ingested_at")
    return add_loss_ratio(fill_claims(joined))


def _join_in_parts(
    premium: DataFrame, claim: DataFrame, keys: Sequence[str], hot: Sequence[HotKey]
) -> DataFrame:
    """The left join with the claims of hot keys in parts.

    A hot key has claims, so of its premium rows only those that met some are kept; every claim is
    in one part and meets each premium row once.
    """
    parts = F.create_map(*(F.lit(x) for h in hot for x in (h.key, h.parts)))
    own, other = "__premium_part", "__claim_part"
    claim_keys = [f"claim_{k}" for k in keys]
    dealt = F.try_element_at(parts, _key_text(claim_keys))
    place = F.pmod(F.monotonically_increasing_id(), dealt.cast("long"))
    claim = claim.withColumn(other, F.coalesce(place, F.lit(0).cast("long")))
    number = F.coalesce(F.try_element_at(parts, _key_text(keys)), F.lit(1)).cast("long")
    premium = premium.withColumn("__parts", number)
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("__parts") - 1))
    premium = premium.withColumn(own, every)
    same = _same_keys(keys) & (F.col(own) == F.col(other))
    joined = premium.join(claim, same, "left")
    kept = (F.col("__parts") == 1) | F.col(other).isNotNull()
    return joined.where(kept).drop(own, other, "__parts")


def repeated_claims(claim: DataFrame, keys: Iterable[str] = SEGMENT_KEYS) -> DataFrame:
    """Claim keys that occur more than once; each would repeat its premium row in the join."""
    claim_keys = [f"claim_{k}" for k in keys]
    known = claim.dropna(subset=claim_keys)
    return known.groupBy(*claim_keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def with_claim_copies(claim: DataFrame, keys: Iterable[str] = SEGMENT_KEYS) -> DataFrame:
    """Claims with ``claim_copies``, how many rows share their key; null when it is not repeated.

    The counts are reduced before their shuffle, and only repeated keys are joined back.
    """
    keys = tuple(keys)
    repeated = repeated_claims(claim, keys).withColumnRenamed("copies", "claim_copies")
    return claim.join(repeated, [f"claim_{k}" for k in keys], "left")


def orphan_claims(
    premium: DataFrame, claim: DataFrame, keys: Iterable[str] = SEGMENT_KEYS
) -> DataFrame:
    """Claims without a premium row. Premium keys are made distinct before they are shuffled."""
    keys = tuple(keys)
    known = premium.select(*keys).distinct()
    return claim.join(known, _same_keys(keys), "left_anti")


def enrich(
    df: DataFrame, regions: DataFrame, key: str = "region_code", dim_key: str = "dim_code"
) -> DataFrame:
    """Add the official region name; an unlisted region keeps its row with a null name.

    No broadcast hint: Spark broadcasts the dimension when its size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise.
    """
    return df.join(regions, F.col(key) == F.col(dim_key), "left").drop(dim_key)


def unknown_regions(
    df: DataFrame, regions: DataFrame, key: str = "region_code", dim_key: str = "dim_code"
) -> DataFrame:
    """Rows whose region is given but not listed."""
    named = df.where(F.col(key).isNotNull())
    return named.join(regions, F.col(key) == F.col(dim_key), "left_anti")


def require_unique(regions: DataFrame, key: str = "dim_code") -> DataFrame:
    """Return the dimension, or raise when a code occurs twice (rows would multiply)."""
    repeated = regions.groupBy(key).count().where("count > 1").select(key).take(5)
    if repeated:
        raise ValueError(f"{key} repeats in the dimension, e.g. {[row[0] for row in repeated]}")
    return regions


def processed(df: DataFrame, run_ts: datetime) -> DataFrame:
    return df.withColumn("processed_at", F.lit(run_ts))
