"""Pure Column expressions; everything here stays inside whole-stage codegen."""

from lossmill.functions.columns import (
    comma_decimal,
    comma_text,
    exact_sum,
    is_malformed,
    loss_amount,
    loss_ratio,
    risk_tier,
    round_snap,
    summands,
    summed,
    to_long,
)

__all__ = [
    "comma_decimal",
    "comma_text",
    "exact_sum",
    "is_malformed",
    "loss_amount",
    "loss_ratio",
    "risk_tier",
    "round_snap",
    "summands",
    "summed",
    "to_long",
]
