"""Exact rounding, ratios and averages.

Money stays decimal. A ratio is divided as double, brought to six decimals and then rounded half up, so that
a tie such as 1.005 rounds the same way wherever the rows were summed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MILLION = 1_000_000


def round2(value: Column) -> Column:
    return F.round(value.cast("decimal(28,6)"), 2).cast("decimal(28,2)")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient; null when the denominator is zero."""
    bottom = denominator.cast("double")
    return numerator.cast("double") / F.nullif(bottom, F.lit(0.0))


def ratio2(numerator: Column, denominator: Column) -> Column:
    return round2(ratio(numerator, denominator))


def percent(numerator: Column, denominator: Column) -> Column:
    return round2(ratio(numerator, denominator) * 100)


def mean(value: Column) -> Column:
    """Average of a decimal column as the exact sum over the exact count."""
    return ratio(F.sum(value), F.count(value))


def mean2(value: Column) -> Column:
    return round2(mean(value))


def money(value: Column) -> Column:
    return F.round(value, 2)


def in_millions(value: Column) -> Column:
    return value.cast("double") / MILLION


def money_label(value: Column) -> Column:
    """Short amount: 1234567 -> $1.2M, 345678 -> $346K, 12 -> $12."""
    amount = value.cast("double")

    def shown(scaled: Column, digits: int, unit: str) -> Column:
        digits_only = F.replace(F.format_number(scaled, digits), F.lit(","), F.lit(""))
        return F.concat(F.lit("$"), digits_only, F.lit(unit))

    return (
        F.when(amount >= MILLION, shown(amount / MILLION, 1, "M"))
        .when(amount >= 1_000, shown(amount / 1_000, 0, "K"))
        .otherwise(shown(amount, 0, ""))
    )
