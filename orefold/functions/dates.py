"""Date parsing and calendar arithmetic."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO = "yyyy-MM-dd"
SLASHED = "M/d/yyyy"


def parse_date(text: Column, pattern: str = ISO) -> Column:
    """Strict parse; anything that does not fit the pattern is null.

    A text that is digits in the shape of the ISO pattern is cast, and of the others only those with a sign, which the pattern
    takes before a year, are given to the parser: it is slow, and slowest on a text that doesn't fit.
    """
    if pattern != ISO:
        return F.try_to_date(text, pattern)
    shaped = text.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z")
    return F.when(shaped, text.try_cast("date")).when(text.rlike(r"\A[+-]"), F.try_to_date(text, pattern))


def parse_any_date(text: Column) -> Column:
    """ISO or month/day/year with or without leading zeros."""
    return F.coalesce(parse_date(text, ISO), parse_date(text, SLASHED))


def day_name_is_weekend(day: Column) -> Column:
    return F.dayname(day).isin("Sat", "Sun")


def years_between(earlier: Column, later: Column) -> Column:
    """Number of year boundaries crossed, not of full years."""
    return F.year(later) - F.year(earlier)


def days_between(earlier: Column, later: Column) -> Column:
    return F.datediff(later, earlier).cast("long")


def today(as_of: date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)


def fiscal_year(year: Column, month: Column) -> Column:
    """Named after the year it ends in; July starts it."""
    return F.when(month >= 7, year + 1).otherwise(year)


def fiscal_month(month: Column) -> Column:
    return (month + 5) % 12 + 1


def fiscal_quarter(month: Column) -> Column:
    """Quarter number 1 to 4 counted from July."""
    return (F.floor((fiscal_month(month) - 1) / 3) + 1).cast("int")
