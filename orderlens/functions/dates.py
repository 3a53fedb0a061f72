"""Calendar functions on dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TRUNC_UNITS = ("day", "week", "month", "quarter", "year")
DIFF_UNITS = ("day", "week", "month", "year")


def date_trunc(unit: str, day: Column) -> Column:
    """First day of the period that holds ``day``, as a date (weeks start on Monday)."""
    if unit not in TRUNC_UNITS:
        raise ValueError(f"unit must be one of {TRUNC_UNITS}, got {unit!r}")
    return day.cast("date") if unit == "day" else F.trunc(day, unit)


def date_diff(start: Column, end: Column, unit: str) -> Column:
    """``end - start``. Days are whole, weeks are days / 7 (fractional), months and
    years count calendar boundaries crossed, not elapsed time."""
    if unit == "day":
        return F.datediff(end, start)
    if unit == "week":
        return F.datediff(end, start) / F.lit(7.0)
    if unit == "month":
        return (F.year(end) * 12 + F.month(end)) - (F.year(start) * 12 + F.month(start))
    if unit == "year":
        return F.year(end) - F.year(start)
    raise ValueError(f"unit must be one of {DIFF_UNITS}, got {unit!r}")


def day_of_week(day: Column) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return F.dayofweek(day) - 1


def period_end(unit: str, day: Column) -> Column:
    """Last day of the week, month or quarter that holds ``day``."""
    start = date_trunc(unit, day)
    if unit == "week":
        return F.date_add(start, 6)
    months = {"month": 1, "quarter": 3, "year": 12}[unit]
    return F.date_sub(F.add_months(start, months), 1)


def year_quarter(day: Column) -> Column:
    """For example ``2023-Q1``."""
    return F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string"))
