"""Typed parsing, normalisation and arithmetic helpers (all JVM-side)."""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(38,2)"

# Fixed value: the cursor given to a row whose business timestamp is missing
# or unparseable at landing time.
CURSOR_FALLBACK = "2024-01-01 00:00:00"

# Non-ISO timestamp layouts accepted when deriving a cursor from free text,
# tried in order after the ISO forms (which a plain cast already parses).
CURSOR_PATTERNS = (
    "yyyy/MM/dd",
    "dd.MM.yyyy",
    "MM/dd/yyyy",
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """``nullif(c, '')``: only the empty string is blank; whitespace is data."""
    c = _col(c)
    return F.when(c == F.lit(""), F.lit(None).cast("string")).otherwise(c)


def normalise_code(c: Column | str) -> Column:
    """``lower(trim(c))`` — trims spaces only, like the SQL original."""
    return F.lower(F.trim(_col(c)))


def to_decimal_or_null(c: Column | str, dtype: str = MONEY) -> Column:
    """Text → decimal with explicit precision; blank or garbage → NULL.

    A bare ``decimal`` cast would be ``decimal(10,0)`` and silently round
    ``-99.50`` to ``-100``, so precision and scale are always spelled out.
    """
    return blank_to_null(c).try_cast(dtype)


def to_date_or_null(c: Column | str) -> Column:
    """Text → date; blank or unparseable → NULL (ANSI casts would throw)."""
    return blank_to_null(c).try_cast("date")


def parse_cursor(c: Column | str, patterns=CURSOR_PATTERNS,
                 fallback: str = CURSOR_FALLBACK) -> Column:
    """Derive a load cursor from a business timestamp in one of several
    layouts; anything unparseable gets the fixed fallback.

    ISO dates and timestamps go through ``try_cast`` (a direct parser, no
    exceptions); only values it rejects reach the pattern-based parsers,
    whose failures are costly, so the common case stays cheap."""
    c = blank_to_null(c)
    tries = [c.try_cast("timestamp")] + [F.try_to_timestamp(c, F.lit(p)) for p in patterns]
    return F.coalesce(*tries, F.lit(fallback).cast("timestamp"))


def flag(predicate: Column) -> Column:
    """A defect flag is never NULL: an unknown predicate counts as false."""
    return F.coalesce(predicate, F.lit(False))


def month_start(c: Column | str) -> Column:
    """First day of the month as a DATE (``date_trunc`` would give a timestamp)."""
    return F.trunc(_col(c), "MM")


def months_between_bounds(lo: Column, hi: Column) -> Column:
    """Array of month starts from ``lo`` to ``hi`` inclusive, empty when
    ``lo > hi`` or either bound is NULL (``sequence`` throws on reversed bounds)."""
    return F.when(
        lo.isNotNull() & hi.isNotNull() & (lo <= hi),
        F.sequence(lo, hi, F.expr("INTERVAL 1 MONTH")),
    ).otherwise(F.array().cast("array<date>"))


def round_ratio(num: Column, den: Column, scale: int = 4, num_scale: int = 0,
                den_scale: int = 0) -> Column:
    """``round(num / nullif(den, 0), scale)`` rounded half away from zero,
    computed exactly in integer arithmetic and returned as ``decimal(38, scale)``.

    ``num_scale`` / ``den_scale`` are the decimal scales of the inputs (0 for
    counts, 2 for money).  Exact for non-negative inputs, which is what counts
    and abs()-corrected money give.  NULL when ``den`` is 0 or NULL.
    """
    big = "decimal(38,0)"
    unit = max(num_scale, den_scale)
    n = (num * F.lit(10 ** unit)).cast(big)
    d = (den * F.lit(10 ** unit)).cast(big)
    # floor((2 * n * 10^scale + d) / (2 * d)) == round-half-up of n / d at ``scale``.
    q = F.call_function("div", (n * F.lit(2 * 10 ** scale) + d).cast(big),
                        (d * F.lit(2)).cast(big))
    q = F.when(d == 0, F.lit(None)).otherwise(q)
    return (q.cast(big) * F.lit(Decimal(1).scaleb(-scale))).cast(f"decimal(38,{scale})")


def as_of_literal(as_of) -> Column:
    """An ``as_of`` value (date, datetime or ISO string) as a DATE literal."""
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.date()
    if isinstance(as_of, _dt.date):
        return F.lit(as_of)
    return F.lit(str(as_of)).cast("date")
