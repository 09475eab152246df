"""Table schemas and the fixed names the layers agree on."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


_S, _D, _L, _T, _B = StringType(), DoubleType(), LongType(), TimestampType(), BooleanType()

PERIOD = "period"
SEGMENT_KEYS = (PERIOD, "region_code", "coverage")

# Raw files: positional, every column text, so the raw layer keeps the source's own digits.
PREMIUM_FILE = _struct(
    region_code=_S, region_name=_S, coverage=_S, exposure=_S, premium=_S, avg_insured=_S
)
CLAIM_FILE = _struct(region_code=_S, region_name=_S, coverage=_S, claim_count=_S, claim_amount=_S)
REGION_FILE = _struct(code=_S, name=_S)

_STAMP = _struct(period=_S, ingested_at=_T, source_file=_S)
BRONZE_PREMIUM = StructType(PREMIUM_FILE.fields + _STAMP.fields)
BRONZE_CLAIM = StructType(CLAIM_FILE.fields + _STAMP.fields)
# Lines with too few or too many fields: what was read of them, and the line as it was.
CORRUPT_LINE = "corrupt_line"
_LINE = [StructField(CORRUPT_LINE, _S, True)]
PREMIUM_LINES = StructType(BRONZE_PREMIUM.fields + _LINE)
CLAIM_LINES = StructType(BRONZE_CLAIM.fields + _LINE)

SILVER = _struct(
    region_code=_S,
    premium_region_name=_S,
    coverage=_S,
    exposure=_D,
    premium=_D,
    avg_insured=_D,
    period=_S,
    premium_ingested_at=_T,
    claim_count=_L,
    claim_amount=_D,
    loss_ratio=_D,
    region_name=_S,
    processed_at=_T,
    high_ratio_alert=_B,
)
QUARANTINE = StructType(SILVER.fields + [StructField("failure_reason", _S, True)])

GOLD_BY_REGION = _struct(
    region_code=_S,
    region_name=_S,
    period=_S,
    total_premium=_D,
    total_claim_amount=_D,
    total_exposure=_D,
    loss_ratio=_D,
    coverage_rows=_L,
    risk_tier=_S,
    processed_at=_T,
)
GOLD_BY_COVERAGE = _struct(
    coverage=_S,
    period=_S,
    total_premium=_D,
    total_claim_amount=_D,
    total_exposure=_D,
    loss_ratio=_D,
    region_rows=_L,
    mean_avg_insured=_D,
    processed_at=_T,
)
GOLD_ALERTS = _struct(
    region_code=_S,
    region_name=_S,
    coverage=_S,
    premium=_D,
    claim_amount=_D,
    loss_ratio=_D,
    exposure=_D,
    period=_S,
    loss_amount=_D,
    processed_at=_T,
)
GOLD_SUMMARY = _struct(
    period=_S,
    total_premium=_D,
    total_claim_amount=_D,
    total_exposure=_D,
    portfolio_loss_ratio=_D,
    segments=_L,
    loss_making_segments=_L,
    max_loss_ratio=_D,
    min_loss_ratio=_D,
    processed_at=_T,
)
LEDGER = _struct(
    table_name=_S, period=_S, operation=_S, row_count=_L, run_ts=_T, version=_L
)

# The column names of the published source files and of tables already built on
# them, per table. `operators.naming` maps between these and the names used here.
_RAW_NAMES = {"region_code": "regiao", "region_name": "descricao", "period": "semestre"}
PUBLISHED_PREMIUM = _RAW_NAMES | {
    "coverage": "tipo_prem",
    "exposure": "exposicao",
    "premium": "premios",
    "avg_insured": "is_media",
}
PUBLISHED_CLAIM = _RAW_NAMES | {
    "coverage": "tipo_sin",
    "claim_count": "numSinistros",
    "claim_amount": "indenizacoes",
}
PUBLISHED_REGION = {"code": "CODIGO", "name": "DESCRICAO"}
PUBLISHED_MARTS = {
    "region_code": "regiao",
    "coverage": "tipo_prem",
    "exposure": "exposicao",
    "premium": "premios",
    "avg_insured": "is_media",
    "claim_count": "num_sinistros",
    "claim_amount": "indenizacoes",
    "loss_ratio": "sinistralidade",
    "period": "semestre",
    "premium_region_name": "descricao_prem",
    "region_name": "reg_descricao_oficial",
    "premium_ingested_at": "prem_ingested_at",
    "high_ratio_alert": "sinistralidade_alert",
    "total_premium": "total_premios",
    "total_claim_amount": "total_indenizacoes",
    "total_exposure": "total_exposicao",
    "coverage_rows": "num_coberturas",
    "region_rows": "num_regioes",
    "mean_avg_insured": "avg_is_media",
    "portfolio_loss_ratio": "sinistralidade_portfolio",
    "segments": "total_segments",
    "max_loss_ratio": "max_sinistralidade",
    "min_loss_ratio": "min_sinistralidade",
}
PUBLISHED_NAMES = {
    "bronze/premium": PUBLISHED_PREMIUM,
    "bronze/claim": PUBLISHED_CLAIM,
    "regions": PUBLISHED_REGION,
    "silver": PUBLISHED_MARTS,
    "gold": PUBLISHED_MARTS,
}
