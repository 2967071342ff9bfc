"""Column-level helpers: every function takes and returns ``Column``s so the
work stays inside Catalyst expressions and whole-stage codegen."""

from ledgerline.functions.columns import (
    blank_to_null,
    flag,
    month_start,
    months_between_bounds,
    normalise_code,
    parse_cursor,
    round_ratio,
    to_date_or_null,
    to_decimal_or_null,
)
from ledgerline.functions.fx import FIXED_EUR_RATES, convert_to_eur

__all__ = [
    "blank_to_null", "flag", "month_start", "months_between_bounds", "normalise_code",
    "parse_cursor", "round_ratio", "to_date_or_null", "to_decimal_or_null",
    "FIXED_EUR_RATES", "convert_to_eur",
]
