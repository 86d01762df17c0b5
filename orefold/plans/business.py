"""The fifteen business questions, plus the repaired return rate."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orefold.functions import bands, dates, numbers
from orefold.operators import returns
from orefold.plans.common import (
    amounts,
    cost,
    growth,
    largest_first,
    orders,
    per,
    profit,
    revenue,
    share_of_total,
    smallest_first,
    units,
    with_customer,
    with_date,
    with_product,
    with_territory,
)

MONTH = ("YEAR", "MONTH_NUM", "MONTH_NAME")


def sales_by_year(fact_sales: DataFrame, dim_date: DataFrame) -> DataFrame:
    return (
        with_date(fact_sales, dim_date, "YEAR")
        .groupBy("YEAR")
        .agg(
            orders().alias("TOTAL_ORDERS"),
            units().alias("TOTAL_UNITS_SOLD"),
            *amounts(TOTAL_REVENUE=revenue(), TOTAL_PROFIT=profit()),
            numbers.mean2(F.col("MARGIN_PCT")).alias("AVG_MARGIN_PCT"),
            per(revenue(), orders()).alias("AVG_ORDER_VALUE"),
        )
        .orderBy(*smallest_first("YEAR"))
    )


def monthly_trend(fact_sales: DataFrame, dim_date: DataFrame) -> DataFrame:
    previous = F.lag("MONTHLY_REVENUE").over(W.orderBy("YEAR", "MONTH_NUM"))
    return (
        with_date(fact_sales, dim_date, *MONTH)
        .groupBy(*MONTH)
        .agg(*amounts(MONTHLY_REVENUE=revenue(), MONTHLY_PROFIT=profit()))
        .withColumn("PREV_MONTH_REVENUE", previous)
        .withColumn("MOM_GROWTH_PCT", growth(F.col("MONTHLY_REVENUE"), F.col("PREV_MONTH_REVENUE")))
        .orderBy(*smallest_first("YEAR", "MONTH_NUM"))
    )


def category_subcategory(fact_sales: DataFrame, dim_product: DataFrame) -> DataFrame:
    return (
        with_product(fact_sales, dim_product, "CATEGORY_NAME", "SUBCATEGORY_NAME")
        .groupBy("CATEGORY_NAME", "SUBCATEGORY_NAME")
        .agg(
            orders().alias("TOTAL_ORDERS"),
            units().alias("UNITS_SOLD"),
            *amounts(TOTAL_REVENUE=revenue(), TOTAL_PROFIT=profit()),
            numbers.mean2(F.col("MARGIN_PCT")).alias("AVG_MARGIN_PCT"),
        )
        .orderBy(*largest_first("TOTAL_REVENUE"), *smallest_first("CATEGORY_NAME", "SUBCATEGORY_NAME"))
    )


def top_products(fact_sales: DataFrame, dim_product: DataFrame, n: int = 10) -> DataFrame:
    """Totals per product first; names are joined to the totals, not to the sales lines."""
    totals = fact_sales.groupBy("PRODUCT_KEY").agg(
        units().alias("UNITS_SOLD"), *amounts(TOTAL_REVENUE=revenue(), TOTAL_PROFIT=profit())
    )
    labels = ("PRODUCT_NAME", "CATEGORY_NAME", "PRICE_TIER")
    return (
        with_product(totals, dim_product, *labels)
        .select("PRODUCT_KEY", *labels, "UNITS_SOLD", "TOTAL_REVENUE", "TOTAL_PROFIT")
        .orderBy(*largest_first("UNITS_SOLD"), *smallest_first("PRODUCT_KEY"))
        .limit(n)
    )


def _orders_of_customers(fact_sales: DataFrame) -> DataFrame:
    """One row per customer and order: all that the customer questions need of the sales lines."""
    return fact_sales.groupBy("CUSTOMER_KEY", "ORDER_NUMBER").agg(
        revenue().alias("GROSS_REVENUE"), F.count("GROSS_REVENUE").alias("LINES")
    )


def customer_segments(fact_sales: DataFrame, dim_customer: DataFrame) -> DataFrame:
    segment = ("INCOME_BAND", "OCCUPATION", "GENDER", "MARITAL_STATUS")
    customers = F.count_distinct("CUSTOMER_KEY")
    return (
        with_customer(_orders_of_customers(fact_sales), dim_customer, *segment)
        .groupBy(*segment)
        .agg(
            customers.alias("CUSTOMER_COUNT"),
            orders().alias("TOTAL_ORDERS"),
            *amounts(TOTAL_REVENUE=revenue()),
            per(revenue(), customers).alias("REVENUE_PER_CUSTOMER"),
        )
        .orderBy(*largest_first("REVENUE_PER_CUSTOMER"), *smallest_first(*segment))
    )


def geography_share(fact_sales: DataFrame, dim_territory: DataFrame) -> DataFrame:
    place = ("CONTINENT", "COUNTRY", "REGION")
    return (
        with_territory(fact_sales, dim_territory, *place)
        .groupBy(*place)
        .agg(orders().alias("TOTAL_ORDERS"), *amounts(TOTAL_REVENUE=revenue(), TOTAL_PROFIT=profit()))
        .withColumn("REVENUE_SHARE_PCT", share_of_total(F.col("TOTAL_REVENUE")))
        .orderBy(*largest_first("TOTAL_REVENUE"), *smallest_first(*place))
    )


def _return_rate(totals: DataFrame, dim_product: DataFrame, n: int) -> DataFrame:
    returned = F.coalesce(F.sum("RETURNED"), F.lit(0))
    return (
        with_product(totals, dim_product, "PRODUCT_NAME", "CATEGORY_NAME")
        .groupBy("PRODUCT_NAME", "CATEGORY_NAME")
        .agg(
            F.sum("SOLD").alias("UNITS_SOLD"),
            returned.alias("UNITS_RETURNED"),
            numbers.percent(returned, F.sum("SOLD")).alias("RETURN_RATE_PCT"),
            *amounts(RETURN_REVENUE_IMPACT=F.coalesce(F.sum("IMPACT"), F.lit(0))),
        )
        .filter(F.col("UNITS_SOLD") > 0)
        .orderBy(*largest_first("RETURN_RATE_PCT"), *smallest_first("PRODUCT_NAME", "CATEGORY_NAME"))
        .limit(n)
    )


def return_rate(fact_sales: DataFrame, dim_product: DataFrame, fact_returns: DataFrame, n: int = 20) -> DataFrame:
    """As published: each sale counted once per return of its product and the reverse."""
    return _return_rate(returns.paired(fact_sales, fact_returns), dim_product, n)


def return_rate_safe(fact_sales: DataFrame, dim_product: DataFrame, fact_returns: DataFrame, n: int = 20) -> DataFrame:
    """Each sale and each return counted once."""
    return _return_rate(returns.per_product(fact_sales, fact_returns), dim_product, n)


def quarterly_yoy(fact_sales: DataFrame, dim_date: DataFrame) -> DataFrame:
    previous = F.lag("QUARTERLY_REVENUE").over(W.partitionBy("QUARTER_NUM").orderBy("YEAR"))
    return (
        with_date(fact_sales, dim_date, "YEAR", "QUARTER_NAME", "QUARTER_NUM")
        .groupBy("YEAR", "QUARTER_NAME", "QUARTER_NUM")
        .agg(*amounts(QUARTERLY_REVENUE=revenue()))
        .withColumn("PREV_YEAR_REVENUE", previous)
        .orderBy(*smallest_first("YEAR", "QUARTER_NUM"))
        .select(
            "YEAR",
            "QUARTER_NAME",
            "QUARTERLY_REVENUE",
            "PREV_YEAR_REVENUE",
            growth(F.col("QUARTERLY_REVENUE"), F.col("PREV_YEAR_REVENUE")).alias("YOY_GROWTH_PCT"),
        )
    )


def customer_lifetime_value(fact_sales: DataFrame, dim_customer: DataFrame, n: int = 20) -> DataFrame:
    labels = ("FULL_NAME", "OCCUPATION", "INCOME_BAND")
    history = fact_sales.groupBy("CUSTOMER_KEY").agg(
        F.min("ORDER_DATE_KEY").alias("FIRST_ORDER_DATE"),
        F.max("ORDER_DATE_KEY").alias("LAST_ORDER_DATE"),
        orders().alias("TOTAL_ORDERS"),
        units().alias("TOTAL_UNITS"),
        *amounts(LIFETIME_REVENUE=revenue(), LIFETIME_PROFIT=profit()),
        per(revenue(), orders()).alias("AVG_ORDER_VALUE"),
    )
    return (
        with_customer(history, dim_customer, *labels)
        .orderBy(*largest_first("LIFETIME_REVENUE"), *smallest_first("CUSTOMER_KEY"))
        .limit(n)
    )


def pivot_regions(unpivoted: DataFrame) -> DataFrame:
    """Regions side by side; a region without sales shows 0."""
    amount = F.col("SALES_AMOUNT")
    return (
        unpivoted.groupBy("SALE_DATE", "PRODUCT_CATEGORY")
        .agg(
            *[
                F.sum(F.when(F.col("REGION") == region, amount).otherwise(0)).alias(region.upper())
                for region in ("North", "Central", "South")
            ],
            F.sum(amount).alias("TOTAL"),
        )
        .orderBy(*smallest_first("SALE_DATE", "PRODUCT_CATEGORY"))
    )


def weekend_weekday(fact_sales: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The average is per order line."""
    day_type = F.when(F.col("IS_WEEKEND"), "Weekend").otherwise("Weekday")
    totals = (
        with_date(fact_sales, dim_date, "IS_WEEKEND")
        .groupBy("IS_WEEKEND")
        .agg(
            orders().alias("TOTAL_ORDERS"),
            *amounts(TOTAL_REVENUE=revenue()),
            numbers.mean2(F.col("GROSS_REVENUE")).alias("AVG_ORDER_REVENUE"),
        )
    )
    return totals.select(
        "IS_WEEKEND", day_type.alias("DAY_TYPE"), "TOTAL_ORDERS", "TOTAL_REVENUE", "AVG_ORDER_REVENUE"
    ).orderBy(*smallest_first("IS_WEEKEND"))


def running_ytd(fact_sales: DataFrame, dim_date: DataFrame) -> DataFrame:
    so_far = W.partitionBy("YEAR").orderBy("MONTH_NUM").rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        with_date(fact_sales, dim_date, *MONTH)
        .groupBy(*MONTH)
        .agg(*amounts(MONTHLY_REVENUE=revenue()))
        .withColumn("YTD_REVENUE", F.sum("MONTHLY_REVENUE").over(so_far))
        .orderBy(*smallest_first("YEAR", "MONTH_NUM"))
    )


def price_tier_mix(fact_sales: DataFrame, dim_product: DataFrame) -> DataFrame:
    tiers = dim_product.select(
        "PRODUCT_KEY", bands.banded(F.col("PRODUCT_PRICE"), bands.REVENUE_MIX_TIERS).alias("PRICE_TIER")
    )
    return (
        with_product(fact_sales, tiers, "PRICE_TIER")
        .groupBy("PRICE_TIER")
        .agg(orders().alias("TOTAL_ORDERS"), units().alias("TOTAL_UNITS"), *amounts(TOTAL_REVENUE=revenue()))
        .withColumn("REVENUE_PCT", share_of_total(F.col("TOTAL_REVENUE")))
        .orderBy(*smallest_first("PRICE_TIER"))
    )


def fiscal_quarter(fact_sales: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Here a fiscal year is named after the year it starts in and the label carries the calendar year."""
    year, month = F.col("YEAR"), F.col("MONTH_NUM")
    label = F.concat(year, F.lit("-Q"), dates.fiscal_quarter(month))
    started = (dates.fiscal_year(year, month) - 1).cast("int")
    return (
        with_date(fact_sales, dim_date, "YEAR", "MONTH_NUM")
        .groupBy(label.alias("FISCAL_QUARTER"), started.alias("FISCAL_YEAR"))
        .agg(
            *amounts(REVENUE=revenue(), COST=cost(), GROSS_PROFIT=revenue() - cost()),
            numbers.percent(revenue() - cost(), revenue()).alias("MARGIN_PCT"),
        )
        .orderBy(*smallest_first("FISCAL_YEAR", "FISCAL_QUARTER"))
    )


def age_bands(fact_sales: DataFrame, dim_customer: DataFrame, as_of: date | None = None) -> DataFrame:
    """The average is per order line; customers without a birth date are left out."""
    customers = F.count_distinct("CUSTOMER_KEY")
    age = dates.years_between(F.col("BIRTH_DATE"), dates.today(as_of))
    banded = dim_customer.filter(F.col("BIRTH_DATE").isNotNull()).select(
        "CUSTOMER_KEY", bands.banded(age, bands.AGE_BANDS).alias("AGE_BAND")
    )
    return (
        with_customer(_orders_of_customers(fact_sales), banded, "AGE_BAND")
        .groupBy("AGE_BAND")
        .agg(
            customers.alias("CUSTOMERS"),
            orders().alias("TOTAL_ORDERS"),
            *amounts(TOTAL_REVENUE=revenue()),
            per(revenue(), F.sum("LINES")).alias("AVG_ORDER_VALUE"),
            per(revenue(), customers).alias("REVENUE_PER_CUSTOMER"),
        )
        .orderBy(*smallest_first("AGE_BAND"))
    )
