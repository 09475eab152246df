"""Column expressions for locale numbers, ratios and tiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SNAP_DIGITS = 12
_TEXT_DIGITS = 8
_EXACT = "decimal(38,12)"
_PLAIN_NUMBER = r"^\s*[+-]?\d+(,\d+)?\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def comma_decimal(c: Column | str, strict: bool = False) -> Column:
    """Text with a comma decimal separator as double; malformed text becomes null.

    Spark also reads ``NaN``, ``Infinity``, ``1d`` or ``1e3`` as doubles. ``strict`` turns those
    into null too, by asking for plain digits first.
    """
    text = _col(c)
    value = F.translate(text, ",", ".").try_cast("double")
    return F.when(text.rlike(_PLAIN_NUMBER), value) if strict else value


def to_long(c: Column | str) -> Column:
    """Text as bigint; malformed text, and text with decimals, becomes null."""
    return _col(c).try_cast("bigint")


def comma_text(c: Column | str, digits: int = 4) -> Column:
    """A number as comma-decimal text. Goes through decimal: a cast of a large double to string
    would give exponent form."""
    fixed = F.round(_col(c).cast(f"decimal(28,{_TEXT_DIGITS})"), digits)
    return F.translate(fixed.cast(f"decimal(28,{digits})").cast("string"), ".", ",")


def is_malformed(raw: Column | str, parsed: Column) -> Column:
    """True when text was present but did not parse."""
    return _col(raw).isNotNull() & parsed.isNull()


def round_snap(c: Column | str, digits: int) -> Column:
    """Half-up rounding of the decimal that a double spells, to fewer than twelve digits.

    The digits are taken to twelve decimals, so only what lies within 5e-13 below a tie goes up
    with it: the last bits of a double do not decide, and no ratio of amounts comes that close.
    NaN, infinities and values from 1e26 on, which have no such decimal, are rounded by Spark.
    """
    if digits >= _SNAP_DIGITS:
        raise ValueError(f"fewer than {_SNAP_DIGITS} digits")
    value = _col(c)
    snapped = F.round(value.try_cast(_EXACT), digits).cast("double")
    return F.coalesce(snapped, F.round(value, digits))


# Values of up to four decimals below _FAST are scaled to whole numbers without a loss, and so are
# those of up to nine decimals below _FAST_FINE: 2 ** 53 is over 9e15.
_FAST, _FAST_FINE = 9e11, 9e6
_PARTS, _CRUMBS = 10_000, 100_000


def _scaled(value: Column, scale: float, below: float) -> Column:
    """``value`` times ``scale`` as bigint; null unless that spells the very same double."""
    whole = F.when(F.abs(value) < below, F.rint(value * scale).cast("bigint"))
    return F.when(whole / F.lit(scale) == value, whole)


def summands(c: Column | str) -> dict[str, Column]:
    """A double as numbers whose sums do not depend on the order of rows.

    Nearly every amount has at most nine decimals and becomes three bigints: whole ``units``,
    ``parts`` of 1/10,000 and ``crumbs`` of 1e-9. Of the others, those that are a decimal of twelve
    digits go to ``odd``; what is left (NaN, infinities, finer or larger values) stays a double in
    ``rest``, whose sum may depend on the order.
    """
    value = _col(c)
    coarse = _scaled(value, 1e4, _FAST)
    fine = F.when(coarse.isNull(), _scaled(value, 1e9, _FAST_FINE))
    scale = _PARTS * _CRUMBS
    kept = coarse.isNotNull() | fine.isNotNull()
    decimal = F.when(~kept, value.try_cast(_EXACT))
    odd = F.when(decimal.cast("double") == value, decimal)
    return {
        "units": F.coalesce(_div(coarse, _PARTS), _div(fine, scale)),
        "parts": F.coalesce(_mod(coarse, _PARTS), _div(_mod(fine, scale), _CRUMBS)),
        "crumbs": _mod(fine, _CRUMBS),
        "odd": odd,
        "rest": F.when(~kept & odd.isNull(), value),
    }


def _div(value: Column, by: int) -> Column:
    """Whole-number quotient toward zero."""
    return F.call_function("div", value, F.lit(by).cast("bigint"))


def _mod(value: Column, by: int) -> Column:
    return value % F.lit(by).cast("bigint")


def exact_sum(c: Column | str) -> Column:
    """The sum of a double column, the same in any order of rows; see ``summands``."""
    return summed({name: F.sum(x) for name, x in summands(c).items()})


def summed(sums: dict[str, Column]) -> Column:
    """The double that sums of ``summands`` add up to; null if there were no values."""
    wide = "decimal(38,12)"
    scales = {"units": 1, "parts": _PARTS, "crumbs": _PARTS * _CRUMBS, "odd": 1}
    total = None
    for name, scale in scales.items():
        fraction = F.lit(f"{1 / scale:.9f}").cast("decimal(10,9)")
        term = sums[name].cast(wide) if scale == 1 else sums[name].cast("decimal(26,0)") * fraction
        term = F.coalesce(term.cast(wide), F.lit(0).cast(wide))
        total = term if total is None else (total + term).cast(wide)
    held = sums["units"].isNotNull() | sums["odd"].isNotNull()
    amount = F.when(held, total.cast("double"))
    return F.coalesce(amount + sums["rest"], amount, sums["rest"])


def loss_ratio(claims: Column | str, premium: Column | str, decimals: int = 4) -> Column:
    """Claims over premium, rounded; null unless the premium is above zero."""
    bottom = _col(premium)
    return F.when(bottom > 0, round_snap(F.try_divide(_col(claims), bottom), decimals))


def loss_amount(claims: Column | str, premium: Column | str) -> Column:
    """What was paid beyond what was collected, in cents."""
    return round_snap(_col(claims) - _col(premium), 2)


def risk_tier(ratio: Column | str, high: float = 1.0, watch: float = 0.7) -> Column:
    """HIGH above ``high``, WATCH above ``watch``, else HEALTHY (also for a null ratio)."""
    value = _col(ratio)
    return F.when(value > high, "HIGH").when(value > watch, "WATCH").otherwise("HEALTHY")
