"""Pieces that the star queries share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orefold.functions.numbers import money, percent, ratio2


def orders() -> Column:
    return F.count_distinct("ORDER_NUMBER")


def units() -> Column:
    return F.sum("ORDER_QUANTITY")


def revenue() -> Column:
    return F.sum("GROSS_REVENUE")


def cost() -> Column:
    return F.sum("TOTAL_COST")


def profit() -> Column:
    return F.sum("GROSS_PROFIT")


def with_date(fact: DataFrame, dim_date: DataFrame, *columns: str) -> DataFrame:
    """Attach calendar columns. Like all dimensions, the calendar is broadcast if Spark finds it small enough."""
    calendar = dim_date.select(F.col("DATE_KEY").alias("ORDER_DATE_KEY"), *columns)
    return fact.join(calendar, "ORDER_DATE_KEY")


def with_product(fact: DataFrame, dim_product: DataFrame, *columns: str) -> DataFrame:
    return fact.join(dim_product.select("PRODUCT_KEY", *columns), "PRODUCT_KEY")


def with_customer(fact: DataFrame, dim_customer: DataFrame, *columns: str) -> DataFrame:
    return fact.join(dim_customer.select("CUSTOMER_KEY", *columns), "CUSTOMER_KEY")


def with_territory(fact: DataFrame, dim_territory: DataFrame, *columns: str) -> DataFrame:
    return fact.join(dim_territory.select("TERRITORY_KEY", *columns), "TERRITORY_KEY")


def share_of_total(amount: Column) -> Column:
    """Share of a row in all rows. Only for a finished aggregate whose size does not follow the fact."""
    return percent(amount, F.sum(amount).over(W.partitionBy()))


def growth(current: Column, previous: Column) -> Column:
    return percent(current - previous, previous)


def per(amount: Column, count: Column) -> Column:
    return ratio2(amount, count)


def amounts(**columns: Column) -> list[Column]:
    return [money(value).alias(name) for name, value in columns.items()]


def largest_first(*columns: str) -> list[Column]:
    """Nulls count as the largest value."""
    return [F.col(c).desc_nulls_first() for c in columns]


def smallest_first(*columns: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]
