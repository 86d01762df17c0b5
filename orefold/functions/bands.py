"""Labels for codes and value ranges. Cut points and labels are fixed values."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

INCOME_BANDS = ((40_000, "Low"), (80_000, "Medium"), (120_000, "High"), (None, "Very High"))
AGE_BANDS = ((30, "18-29"), (40, "30-39"), (50, "40-49"), (60, "50-59"), (None, "60+"))

# Three tierings are in use and differ on purpose.
CATALOGUE_TIERS = ((50, "Budget"), (250, "Mid-Range"), (1000, "Premium"), (None, "Luxury"))
REVENUE_MIX_TIERS = (
    (50, "01_Budget (<$50)"),
    (200, "02_Mid-Range ($50-$199)"),
    (500, "03_Premium ($200-$499)"),
    (None, "04_Luxury ($500+)"),
)
REPORT_TIERS = (
    (50, "Budget (<$50)"),
    (200, "Mid ($50-200)"),
    (500, "Premium ($200-500)"),
    (None, "Luxury (>$500)"),
)

# (at most this many days since the last order, at least this many orders, segment)
RFM_SEGMENTS = (
    (30, 5, "Champions"),
    (90, 3, "Loyal"),
    (180, 2, "Potential Loyalist"),
    (365, 0, "At Risk"),
)
RFM_REST = "Lost"

REGION_CODES = {
    "Northwest": "NW",
    "Northeast": "NE",
    "Central": "CTR",
    "Southwest": "SW",
    "Southeast": "SE",
    "Canada": "CAN",
    "France": "FR",
    "Germany": "DE",
    "Australia": "AU",
    "United Kingdom": "UK",
}

MARITAL_LABELS = {"M": "Married", "S": "Single"}
GENDER_LABELS = {"M": "Male", "F": "Female"}
GENDER_LABELS_WIDE = {"M": "Male", "MALE": "Male", "F": "Female", "FEMALE": "Female"}


def banded(value: Column, bands: tuple) -> Column:
    """Label of the first band whose upper bound exceeds the value.

    A null is below no bound, so it takes the label of the open last band.
    """
    *bounded, (_, rest) = bands
    label = F.lit(rest)
    for bound, name in reversed(bounded):
        label = F.when(value < bound, F.lit(name)).otherwise(label)
    return label


def lookup(value: Column, labels: dict[str, str]) -> Column:
    """Label for an exact code, null for any other."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(labels.items())])
    return F.try_element_at(table, value)


def labelled(value: Column, labels: dict[str, str], default: str = "Unknown") -> Column:
    return F.coalesce(lookup(value, labels), F.lit(default))


def normalized_gender(value: Column) -> Column:
    """Accepts M, F, Male and Female in any case."""
    return labelled(F.upper(F.trim(value)), GENDER_LABELS_WIDE)


def region_code(region: Column) -> Column:
    return F.coalesce(lookup(region, REGION_CODES), F.upper(F.left(region, F.lit(3))))


def rfm_segment(recency_days: Column, frequency: Column) -> Column:
    label = F.lit(RFM_REST)
    for days, orders, name in reversed(RFM_SEGMENTS):
        label = F.when((recency_days <= days) & (frequency >= orders), F.lit(name)).otherwise(label)
    return label
