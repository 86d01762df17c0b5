"""Report datasets computed from raw sales and lookups, key figures, table cuts and chart series.

Amounts are kept unrounded per line and rounded once per report row. A null group key gives no report row.
Functions ending in ``_sql`` are the variants computed from the star schema; they differ where stated.
"""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orefold.functions import bands, dates, numbers
from orefold.operators import returns as return_totals
from orefold.operators import silver
from orefold.plans.common import (
    amounts,
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

_LINE_MARGIN = "decimal(28,10)"
_CUSTOMER_LABELS = ("ANNUALINCOME", "GENDER", "OCCUPATION", "MARITALSTATUS")
_TERRITORY_LABELS = ("REGION", "COUNTRY")

# What the datasets read of lines without labels of customers and territories, and the keys by which a dataset gets those:
# a lookup with repeated keys multiplies the lines of the datasets that need it and no others.
REPORTED = (
    *("YEAR", "MONTH", "ORDERNUMBER", "CUSTOMERKEY", "TERRITORYKEY", "PRODUCTKEY", "PRODUCTNAME", "CATEGORYNAME", "PRICE_TIER"),
    *("ORDERQUANTITY", "REVENUE", "PROFIT", "MARGIN"),
)


def _key(column: str) -> Column:
    return F.expr(f"try_cast({column} AS BIGINT)").alias(column)


def _number(column: str) -> Column:
    return F.coalesce(F.expr(f"try_cast({column} AS DECIMAL(12,4))"), F.lit(0)).cast("decimal(12,4)").alias(column)


def one_per_key(lookup: DataFrame, key: str) -> DataFrame:
    """The smallest row of each key, so that a lookup with repeated keys multiplies no line."""
    rest = [c for c in lookup.columns if c != key]
    return lookup.groupBy(key).agg(F.min(F.struct(*rest)).alias("ROW")).select(key, "ROW.*").select(*lookup.columns)


def with_people(lines: DataFrame, customers: DataFrame) -> DataFrame:
    return lines.join(customers.select(_key("CUSTOMERKEY"), *_CUSTOMER_LABELS), "CUSTOMERKEY", "left")


def with_places(lines: DataFrame, territories: DataFrame) -> DataFrame:
    places = territories.select(_key("SALESTERRITORYKEY").alias("TERRITORYKEY"), *_TERRITORY_LABELS)
    return lines.join(places, "TERRITORYKEY", "left")


def enrich(
    sales: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    subcategories: DataFrame,
    categories: DataFrame,
    territories: DataFrame,
    wanted: Collection[str] | None = None,
) -> DataFrame:
    """Sales lines of all years (raw rows with their FILE_YEAR) with lookups, measures, month and report price tier.

    Lookups that do not match leave nulls; a missing price, cost or quantity counts as 0. ``wanted`` names the customer
    and territory columns needed, all by default; a lookup that supplies none of them is not joined, which saves a
    shuffle of the lines. It changes no row because keys of customers and territories have to be unique:
    ``profiling.duplicate_groups`` reports those that are not, ``one_per_key`` reduces such a lookup.
    """
    sales = sales.select(
        "ORDERNUMBER",
        "ORDERDATE",
        _key("CUSTOMERKEY"),
        _key("PRODUCTKEY"),
        _key("TERRITORYKEY"),
        "ORDERQUANTITY",
        F.col(silver.FILE_YEAR).alias("YEAR"),
    )
    category_names = subcategories.select(_key("PRODUCTSUBCATEGORYKEY"), _key("PRODUCTCATEGORYKEY")).join(
        categories.select(_key("PRODUCTCATEGORYKEY"), "CATEGORYNAME"), "PRODUCTCATEGORYKEY", "left"
    )
    catalogue = products.select(
        _key("PRODUCTKEY"), _key("PRODUCTSUBCATEGORYKEY"), "PRODUCTNAME", "PRODUCTCOST", "PRODUCTPRICE"
    ).join(category_names, "PRODUCTSUBCATEGORYKEY", "left")
    catalogue = catalogue.select("PRODUCTKEY", "PRODUCTNAME", "CATEGORYNAME", "PRODUCTCOST", "PRODUCTPRICE")
    joined = sales.join(catalogue, "PRODUCTKEY", "left")
    if wanted is None or set(wanted) & set(_CUSTOMER_LABELS):
        joined = with_people(joined, customers)
    if wanted is None or set(wanted) & set(_TERRITORY_LABELS):  # last: no shuffle moves the labels of this small lookup
        joined = with_places(joined, territories)
    measured = joined.withColumns(
        {
            "PRODUCTPRICE": _number("PRODUCTPRICE"),
            "PRODUCTCOST": _number("PRODUCTCOST"),
            "ORDERQUANTITY": F.coalesce(F.expr("try_cast(ORDERQUANTITY AS BIGINT)"), F.lit(0)).cast("long"),
        }
    )
    quantity, price, cost = F.col("ORDERQUANTITY"), F.col("PRODUCTPRICE"), F.col("PRODUCTCOST")
    return measured.withColumns(
        {
            "REVENUE": (quantity * price).cast("decimal(20,4)"),
            "COST": (quantity * cost).cast("decimal(20,4)"),
            "PROFIT": (quantity * price - quantity * cost).cast("decimal(20,4)"),
            "MONTH": F.month(dates.parse_date(F.col("ORDERDATE"))),
            "PRICE_TIER": bands.banded(price, bands.REPORT_TIERS),
        }
    ).withColumn("MARGIN", (numbers.ratio(F.col("PROFIT"), F.col("REVENUE")) * 100).cast(_LINE_MARGIN))


def _grouped(lines: DataFrame, *keys: str) -> DataFrame:
    present = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    return lines.filter(present).groupBy(*keys)


def _order_count() -> Column:
    return F.count_distinct("ORDERNUMBER").alias("ORDERS")


def _units() -> Column:
    return F.sum("ORDERQUANTITY")


def _revenue() -> Column:
    return F.sum("REVENUE")


def _profit() -> Column:
    return F.sum("PROFIT")


def sales_by_year(lines: DataFrame) -> DataFrame:
    """The margin is total profit over total revenue."""
    return (
        _grouped(lines, "YEAR")
        .agg(
            _order_count(),
            _units().alias("UNITS"),
            *amounts(REVENUE=_revenue(), PROFIT=_profit()),
            numbers.percent(_profit(), _revenue()).alias("MARGIN_PCT"),
        )
        .orderBy("YEAR")
    )


def monthly_trend(lines: DataFrame) -> DataFrame:
    return (
        _grouped(lines, "YEAR", "MONTH")
        .agg(*amounts(REVENUE=_revenue()))
        .select(
            "YEAR",
            F.col("MONTH").alias("MONTH_NUM"),
            F.monthname(F.make_date(F.col("YEAR"), F.col("MONTH"), F.lit(1))).alias("MONTH_NAME"),
            "REVENUE",
        )
        .orderBy("YEAR", "MONTH_NUM")
    )


def category_revenue(lines: DataFrame) -> DataFrame:
    """The margin is the mean over lines that have one."""
    return (
        _grouped(lines, "CATEGORYNAME")
        .agg(
            _units().alias("UNITS_SOLD"),
            *amounts(REVENUE=_revenue(), PROFIT=_profit()),
            numbers.mean2(F.col("MARGIN")).alias("MARGIN_PCT"),
        )
        .withColumnRenamed("CATEGORYNAME", "CATEGORY_NAME")
        .orderBy(*largest_first("REVENUE"), "CATEGORY_NAME")
    )


def top_products(lines: DataFrame, n: int = 15) -> DataFrame:
    return (
        _grouped(lines, "PRODUCTNAME", "CATEGORYNAME", "PRICE_TIER")
        .agg(_units().alias("UNITS_SOLD"), *amounts(REVENUE=_revenue(), PROFIT=_profit()))
        .withColumnsRenamed({"PRODUCTNAME": "PRODUCT_NAME", "CATEGORYNAME": "CATEGORY_NAME"})
        .orderBy(*largest_first("REVENUE"), "PRODUCT_NAME", "CATEGORY_NAME", "PRICE_TIER")
        .limit(n)
    )


def territory(lines: DataFrame) -> DataFrame:
    return (
        _grouped(lines, "COUNTRY", "REGION")
        .agg(_order_count(), *amounts(REVENUE=_revenue(), PROFIT=_profit()))
        .orderBy(*largest_first("REVENUE"), "COUNTRY", "REGION")
    )


def customer_segment(lines: DataFrame) -> DataFrame:
    return (
        _grouped(lines, "OCCUPATION", "GENDER")
        .agg(F.count_distinct("CUSTOMERKEY").alias("CUSTOMERS"), *amounts(REVENUE=_revenue()))
        .withColumn("REV_PER_CUST", per(F.col("REVENUE"), F.col("CUSTOMERS")))
        .orderBy(*largest_first("REVENUE"), "OCCUPATION", "GENDER")
    )


def returns(lines: DataFrame, raw_returns: DataFrame) -> DataFrame:
    """Units per category; both sides are totalled per product before they meet."""
    back = (
        _grouped(raw_returns.select(_key("PRODUCTKEY"), "RETURNQUANTITY"), "PRODUCTKEY")
        .agg(F.sum("RETURNQUANTITY").alias("UNITS_RETURNED"))
    )
    sold = _grouped(lines, "PRODUCTKEY").agg(
        _units().alias("UNITS_SOLD"), F.first("CATEGORYNAME", ignorenulls=True).alias("CATEGORY_NAME")
    )
    returned = F.coalesce(F.sum("UNITS_RETURNED"), F.lit(0)).cast("long")
    return (
        _grouped(sold.join(back, "PRODUCTKEY", "left"), "CATEGORY_NAME")
        .agg(
            F.sum("UNITS_SOLD").alias("UNITS_SOLD"),
            returned.alias("UNITS_RETURNED"),
            numbers.percent(returned, F.sum("UNITS_SOLD")).alias("RETURN_RATE_PCT"),
        )
        .orderBy(*largest_first("UNITS_RETURNED"), "CATEGORY_NAME")
    )


# Variants from the star schema.


def sales_by_year_sql(fact_sales: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The margin is the mean of the line margins."""
    return (
        with_date(fact_sales, dim_date, "YEAR")
        .groupBy("YEAR")
        .agg(
            orders().alias("ORDERS"),
            units().alias("UNITS"),
            *amounts(REVENUE=revenue(), PROFIT=profit()),
            numbers.mean2(F.col("MARGIN_PCT")).alias("MARGIN_PCT"),
        )
        .orderBy(*smallest_first("YEAR"))
    )


def monthly_trend_sql(fact_sales: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Adds the profit."""
    month = ("YEAR", "MONTH_NUM", "MONTH_NAME")
    return (
        with_date(fact_sales, dim_date, *month)
        .groupBy(*month)
        .agg(*amounts(REVENUE=revenue(), PROFIT=profit()))
        .orderBy(*smallest_first("YEAR", "MONTH_NUM"))
    )


def category_revenue_sql(fact_sales: DataFrame, dim_product: DataFrame) -> DataFrame:
    """The margin is the list margin, averaged over the lines."""
    return (
        with_product(fact_sales, dim_product, "CATEGORY_NAME")
        .groupBy("CATEGORY_NAME")
        .agg(
            units().alias("UNITS_SOLD"),
            *amounts(REVENUE=revenue(), PROFIT=profit()),
            numbers.mean2(F.col("MARGIN_PCT")).alias("MARGIN_PCT"),
        )
        .orderBy(*largest_first("REVENUE"), *smallest_first("CATEGORY_NAME"))
    )


def top_products_sql(fact_sales: DataFrame, dim_product: DataFrame, n: int = 15) -> DataFrame:
    """Uses the catalogue price tier."""
    labels = ("PRODUCT_NAME", "CATEGORY_NAME", "PRICE_TIER")
    totals = fact_sales.groupBy("PRODUCT_KEY").agg(
        units().alias("UNITS"), revenue().alias("REVENUE_OF_KEY"), profit().alias("PROFIT_OF_KEY")
    )
    return (
        with_product(totals, dim_product, *labels)
        .groupBy(*labels)
        .agg(
            F.sum("UNITS").alias("UNITS_SOLD"),
            *amounts(REVENUE=F.sum("REVENUE_OF_KEY"), PROFIT=F.sum("PROFIT_OF_KEY")),
        )
        .orderBy(*largest_first("REVENUE"), *smallest_first(*labels))
        .limit(n)
    )


def territory_sql(fact_sales: DataFrame, dim_territory: DataFrame) -> DataFrame:
    return (
        with_territory(fact_sales, dim_territory, "COUNTRY", "REGION")
        .groupBy("COUNTRY", "REGION")
        .agg(orders().alias("ORDERS"), *amounts(REVENUE=revenue(), PROFIT=profit()))
        .orderBy(*largest_first("REVENUE"), *smallest_first("COUNTRY", "REGION"))
    )


def customer_segment_sql(fact_sales: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Adds the income band; totals per customer are joined to the labels."""
    segment = ("INCOME_BAND", "OCCUPATION", "GENDER")
    totals = fact_sales.groupBy("CUSTOMER_KEY").agg(revenue().alias("REVENUE_OF_KEY"))
    customers, total = F.count_distinct("CUSTOMER_KEY"), F.sum("REVENUE_OF_KEY")
    return (
        with_customer(totals, dim_customer, *segment)
        .groupBy(*segment)
        .agg(
            customers.alias("CUSTOMERS"),
            *amounts(REVENUE=total),
            per(total, customers).alias("REV_PER_CUST"),
        )
        .orderBy(*largest_first("REVENUE"), *smallest_first(*segment))
    )


def returns_sql(fact_sales: DataFrame, fact_returns: DataFrame, dim_product: DataFrame) -> DataFrame:
    """As published: each return counted once per sale of its product and the reverse; unsold products stay."""
    totals = return_totals.paired_from_returns(fact_sales, fact_returns)
    return (
        with_product(totals, dim_product, "CATEGORY_NAME")
        .groupBy("CATEGORY_NAME")
        .agg(
            F.sum("RETURNED").alias("UNITS_RETURNED"),
            F.coalesce(F.sum("SOLD"), F.lit(0)).alias("UNITS_SOLD"),
            numbers.percent(F.sum("RETURNED"), F.sum("SOLD")).alias("RETURN_RATE_PCT"),
        )
        .orderBy(*largest_first("UNITS_RETURNED"), *smallest_first("CATEGORY_NAME"))
    )


# Key figures, cuts and chart series work on finished report datasets.


def kpis(by_year: DataFrame, categories: DataFrame, territories: DataFrame) -> DataFrame:
    """One row. Orders are added up over the years, not counted again."""

    def leader(dataset: DataFrame, label: str, *ties: str) -> Column:
        best = dataset.orderBy(*largest_first("REVENUE"), label, *ties).limit(1).select(label)
        return F.coalesce(best.scalar(), F.lit("N/A"))

    return by_year.agg(
        _revenue().alias("TOTAL_REVENUE"),
        _profit().alias("TOTAL_PROFIT"),
        F.sum("ORDERS").alias("TOTAL_ORDERS"),
        numbers.percent(_profit(), _revenue()).alias("AVG_MARGIN"),
        F.concat_ws(",", F.sort_array(F.collect_set("YEAR")).cast("array<string>")).alias("YEARS"),
    ).select(
        "TOTAL_REVENUE",
        "TOTAL_PROFIT",
        "TOTAL_ORDERS",
        "AVG_MARGIN",
        leader(categories, "CATEGORY_NAME").alias("TOP_CATEGORY"),
        leader(territories, "COUNTRY", "REGION").alias("TOP_COUNTRY"),
        "YEARS",
    )


def first_months(trend: DataFrame, n: int = 36) -> DataFrame:
    return trend.orderBy("YEAR", "MONTH_NUM").limit(n)


def first_segments(segments: DataFrame, n: int) -> DataFrame:
    return segments.orderBy(*largest_first("REVENUE"), "OCCUPATION", "GENDER").limit(n)


def chart_revenue_by_year(by_year: DataFrame) -> DataFrame:
    return by_year.select("YEAR", numbers.in_millions(F.col("REVENUE")).alias("REVENUE_M"))


def chart_monthly_by_year(trend: DataFrame) -> DataFrame:
    return trend.select("YEAR", "MONTH_NUM", numbers.in_millions(F.col("REVENUE")).alias("REVENUE_M")).orderBy(
        "YEAR", "MONTH_NUM"
    )


def chart_top_categories(categories: DataFrame, n: int = 8) -> DataFrame:
    top = categories.orderBy(*largest_first("REVENUE"), "CATEGORY_NAME").limit(n)
    return top.select("CATEGORY_NAME", numbers.in_millions(F.col("REVENUE")).alias("REVENUE_M"))


def _share(dataset: DataFrame, label: str) -> DataFrame:
    return dataset.select(label, share_of_total(F.col("REVENUE")).alias("SHARE_PCT"))


def chart_category_share(categories: DataFrame, n: int = 6) -> DataFrame:
    """Shares within the first ``n`` categories."""
    return _share(categories.orderBy(*largest_first("REVENUE"), "CATEGORY_NAME").limit(n), "CATEGORY_NAME")


def chart_top_territories(territories: DataFrame, n: int = 8) -> DataFrame:
    top = territories.orderBy(*largest_first("REVENUE"), "COUNTRY", "REGION").limit(n)
    return top.select("COUNTRY", numbers.in_millions(F.col("REVENUE")).alias("REVENUE_M"))


def chart_occupation(segments: DataFrame) -> DataFrame:
    totals = segments.groupBy("OCCUPATION").agg(F.sum("REVENUE").alias("REVENUE"))
    return totals.select("OCCUPATION", numbers.in_millions(F.col("REVENUE")).alias("REVENUE_M")).orderBy(
        *largest_first("REVENUE_M"), "OCCUPATION"
    )


def chart_gender_share(segments: DataFrame) -> DataFrame:
    return _share(segments.groupBy("GENDER").agg(F.sum("REVENUE").alias("REVENUE")), "GENDER")


def chart_top_returns(by_category: DataFrame, n: int = 8) -> DataFrame:
    top = by_category.orderBy(*largest_first("UNITS_RETURNED"), "CATEGORY_NAME").limit(n)
    return top.select("CATEGORY_NAME", "UNITS_RETURNED")
