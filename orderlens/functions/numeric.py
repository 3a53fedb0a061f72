"""Arithmetic with explicit rules for zero, NULL and rounding.

Money stays decimal until the last step. Ratios are taken in double, because a
decimal division would round at a scale that depends on the operands' types.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division, NULL when the denominator is zero or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def safe_divide(numerator: Column, denominator: Column, default: float | None = 0.0) -> Column:
    """Double division, ``default`` when the denominator is zero or NULL."""
    bad = denominator.isNull() | (denominator == 0)
    return F.when(bad, F.lit(default).cast("double")).otherwise(ratio(numerator, denominator))


def pct_of(numerator: Column, denominator: Column) -> Column:
    """Share in percent, 0 unless the denominator is positive."""
    return F.when(denominator > 0, ratio(numerator, denominator) * 100).otherwise(F.lit(0.0))


def pct_change(current: Column, previous: Column) -> Column:
    """Growth in percent, NULL unless the previous value is positive."""
    return F.when(previous > 0, ratio(current - previous, previous) * 100)


def money_avg(total: Column, count: Column) -> Column:
    """Mean from an exact total: one rounding, independent of the row order."""
    return ratio(total, count)


def round_to(value: Column, digits: int) -> Column:
    """Round a double half away from zero: scaled, rounded to a whole number, scaled
    back, so that each step is the plain floating-point operation."""
    scale = F.lit(float(10**digits))
    return F.round(value.cast("double") * scale, 0) / scale


def cents_to_dollars(cents: Column, precision: int = 2) -> Column:
    return F.round(cents.cast("decimal(28,0)") / F.lit(100), precision)


def dollars_to_cents(dollars: Column) -> Column:
    return F.round(dollars.cast("decimal(28,6)") * 100, 0).cast("bigint")
