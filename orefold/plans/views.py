"""The six analytical views, the repaired product view and the monthly aggregate table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orefold.functions import bands, numbers
from orefold.operators import returns
from orefold.plans.common import (
    amounts,
    cost,
    orders,
    per,
    profit,
    revenue,
    share_of_total,
    units,
    with_customer,
    with_date,
    with_product,
    with_territory,
)

_DATE_LABELS = ("YEAR", "MONTH_NAME", "QUARTER_NAME", "DAY_OF_WEEK_NAME", "IS_WEEKEND", "FISCAL_YEAR", "FISCAL_QUARTER")
_PRODUCT_LABELS = (
    "PRODUCT_NAME",
    "PRODUCT_SKU",
    "MODEL_NAME",
    "PRODUCT_COLOR",
    "PRODUCT_SIZE",
    "SUBCATEGORY_NAME",
    "CATEGORY_NAME",
    "PRICE_TIER",
)
_CUSTOMER_LABELS = ("GENDER", "MARITAL_STATUS", "OCCUPATION", "INCOME_BAND", "EDUCATION_LEVEL", "IS_HOME_OWNER", "AGE")
_TERRITORY_LABELS = ("REGION", "COUNTRY", "CONTINENT")
_MEASURES = (
    "ORDER_QUANTITY",
    "UNIT_PRICE",
    "UNIT_COST",
    "GROSS_REVENUE",
    "TOTAL_COST",
    "GROSS_PROFIT",
    "MARGIN_PCT",
    "LEAD_TIME_DAYS",
)


def sales_detail(
    fact_sales: DataFrame, dim_date: DataFrame, dim_product: DataFrame, dim_customer: DataFrame, dim_territory: DataFrame
) -> DataFrame:
    """One labelled row per order line; a line that misses a dimension row is dropped.

    The lines carry what they got from one shuffle to the next, so the small dimensions come last.
    """
    lines = fact_sales.select(
        "ORDER_NUMBER",
        "ORDER_LINE_ITEM",
        "SALES_YEAR",
        "ORDER_DATE_KEY",
        "PRODUCT_KEY",
        "CUSTOMER_KEY",
        "TERRITORY_KEY",
        *_MEASURES,
    )
    described = with_product(lines, dim_product, *_PRODUCT_LABELS)
    owned = with_customer(described, dim_customer, "FULL_NAME", *_CUSTOMER_LABELS)
    placed = with_territory(owned, dim_territory, *_TERRITORY_LABELS)
    return with_date(placed, dim_date, *_DATE_LABELS).select(
        "ORDER_NUMBER",
        "ORDER_LINE_ITEM",
        "SALES_YEAR",
        F.col("ORDER_DATE_KEY").alias("ORDER_DATE"),
        *_DATE_LABELS,
        *_PRODUCT_LABELS,
        F.col("FULL_NAME").alias("CUSTOMER_NAME"),
        *_CUSTOMER_LABELS,
        *_TERRITORY_LABELS,
        *_MEASURES,
    )


def monthly_kpi(fact_sales: DataFrame, dim_date: DataFrame) -> DataFrame:
    month = ("YEAR", "MONTH_NUM", "MONTH_NAME")
    label = F.concat(F.col("YEAR"), F.lit("-"), F.lpad(F.col("MONTH_NUM").cast("string"), 2, "0"))
    totals = (
        with_date(fact_sales, dim_date, *month)
        .groupBy(*month)
        .agg(
            orders().alias("TOTAL_ORDERS"),
            F.count("ORDER_LINE_ITEM").alias("TOTAL_LINE_ITEMS"),
            units().alias("TOTAL_UNITS"),
            *amounts(TOTAL_REVENUE=revenue(), TOTAL_COST=cost(), TOTAL_PROFIT=profit()),
            numbers.mean2(F.col("MARGIN_PCT")).alias("AVG_MARGIN_PCT"),
            per(revenue(), orders()).alias("AVG_ORDER_VALUE"),
        )
    )
    return totals.select(*month, label.alias("YEAR_MONTH"), *[c for c in totals.columns if c not in month])


_PERFORMANCE_KEYS = (
    "PRODUCT_KEY",
    "PRODUCT_NAME",
    "PRODUCT_SKU",
    "CATEGORY_NAME",
    "SUBCATEGORY_NAME",
    "PRICE_TIER",
    "PRODUCT_PRICE",
)


def _performance(totals: DataFrame, dim_product: DataFrame) -> DataFrame:
    returned = F.coalesce(F.col("RETURNED"), F.lit(0))
    labels = dim_product.select(*_PERFORMANCE_KEYS, F.col("MARGIN_PCT").alias("LIST_MARGIN_PCT"))
    return totals.join(labels, "PRODUCT_KEY").select(
        *_PERFORMANCE_KEYS,
        "LIST_MARGIN_PCT",
        F.col("SOLD").alias("UNITS_SOLD"),
        *amounts(TOTAL_REVENUE=F.col("REVENUE"), TOTAL_PROFIT=F.col("PROFIT")),
        returned.alias("UNITS_RETURNED"),
        numbers.percent(returned, F.col("SOLD")).alias("RETURN_RATE_PCT"),
        *amounts(RETURN_REVENUE_IMPACT=F.coalesce(F.col("IMPACT"), F.lit(0))),
    )


def product_performance(fact_sales: DataFrame, dim_product: DataFrame, fact_returns: DataFrame) -> DataFrame:
    """Totals as the published view has them: each sale counted once per return of its product."""
    return _performance(returns.paired(fact_sales, fact_returns), dim_product)


def product_performance_safe(fact_sales: DataFrame, dim_product: DataFrame, fact_returns: DataFrame) -> DataFrame:
    """Each sale and each return counted once."""
    return _performance(returns.per_product(fact_sales, fact_returns), dim_product)


def customer_360(fact_sales: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Demographics, purchase history and segment of every customer with an order."""
    latest = fact_sales.agg(F.max("ORDER_DATE_KEY")).scalar()
    history = fact_sales.groupBy("CUSTOMER_KEY").agg(
        F.min("ORDER_DATE_KEY").alias("FIRST_PURCHASE_DATE"),
        F.max("ORDER_DATE_KEY").alias("LAST_PURCHASE_DATE"),
        orders().alias("FREQUENCY"),
        *amounts(MONETARY_VALUE=revenue()),
        per(revenue(), orders()).alias("AVG_ORDER_VALUE"),
        units().alias("TOTAL_UNITS_PURCHASED"),
    )
    recency = F.datediff(latest, F.col("LAST_PURCHASE_DATE")).alias("RECENCY_DAYS")
    labels = (
        "FULL_NAME",
        "GENDER",
        "AGE",
        "INCOME_BAND",
        "OCCUPATION",
        "EDUCATION_LEVEL",
        "MARITAL_STATUS",
        "IS_HOME_OWNER",
    )
    return (
        with_customer(history, dim_customer, *labels)
        .select(
            "CUSTOMER_KEY",
            *labels,
            "FIRST_PURCHASE_DATE",
            "LAST_PURCHASE_DATE",
            recency,
            "FREQUENCY",
            "MONETARY_VALUE",
            "AVG_ORDER_VALUE",
            "TOTAL_UNITS_PURCHASED",
        )
        .withColumn("RFM_SEGMENT", bands.rfm_segment(F.col("RECENCY_DAYS"), F.col("FREQUENCY")))
    )


def territory_summary(fact_sales: DataFrame, dim_territory: DataFrame) -> DataFrame:
    place = ("CONTINENT", "COUNTRY", "REGION", "REGION_CODE")
    return (
        with_territory(fact_sales, dim_territory, *place)
        .groupBy(*place)
        .agg(
            orders().alias("TOTAL_ORDERS"),
            units().alias("TOTAL_UNITS"),
            *amounts(TOTAL_REVENUE=revenue(), TOTAL_PROFIT=profit()),
        )
        .withColumn("REVENUE_SHARE_PCT", share_of_total(F.col("TOTAL_REVENUE")))
    )


def return_analysis(
    fact_returns: DataFrame, dim_product: DataFrame, dim_territory: DataFrame, dim_date: DataFrame
) -> DataFrame:
    calendar = dim_date.select(
        F.col("DATE_KEY").alias("RETURN_DATE_KEY"),
        F.col("YEAR").alias("RETURN_YEAR"),
        F.col("MONTH_NAME").alias("RETURN_MONTH"),
    )
    dated = fact_returns.join(calendar, "RETURN_DATE_KEY")
    placed = with_territory(dated, dim_territory, "REGION", "COUNTRY")
    named = with_product(placed, dim_product, "PRODUCT_NAME", "CATEGORY_NAME", "SUBCATEGORY_NAME")
    return named.select(
        F.col("RETURN_DATE_KEY").alias("RETURN_DATE"),
        "RETURN_YEAR",
        "RETURN_MONTH",
        "PRODUCT_NAME",
        "CATEGORY_NAME",
        "SUBCATEGORY_NAME",
        "REGION",
        "COUNTRY",
        "RETURN_QUANTITY",
        "UNIT_PRICE",
        "RETURN_REVENUE_IMPACT",
    )


def monthly_revenue(fact_sales: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Content of the stored monthly aggregate."""
    month = ("YEAR", "MONTH_NUM", "MONTH_NAME")
    return (
        with_date(fact_sales, dim_date, *month)
        .groupBy(*month)
        .agg(*amounts(TOTAL_REVENUE=revenue(), TOTAL_PROFIT=profit()), orders().alias("TOTAL_ORDERS"))
    )


MONTH = ("YEAR", "MONTH_NUM")


def months_of(lines: DataFrame, dim_date: DataFrame) -> list[tuple[int, int]]:
    """The calendar months that the lines fall into, ascending; only ORDER_DATE_KEY is read."""
    days = lines.select("ORDER_DATE_KEY").distinct()
    return sorted(tuple(row) for row in with_date(days, dim_date, *MONTH).select(*MONTH).distinct().collect())


def monthly_revenue_of(fact_sales: DataFrame, dim_date: DataFrame, months: list[tuple[int, int]]) -> DataFrame:
    """The stored monthly aggregate for some months; the fact is read by their dates only."""
    wanted = [(F.col("YEAR") == year) & (F.col("MONTH_NUM") == month) for year, month in months]
    days = dim_date.filter(reduce(Column.__or__, wanted, F.lit(False)))
    spans = days.groupBy(*MONTH).agg(F.min("DATE_KEY").alias("FIRST"), F.max("DATE_KEY").alias("LAST")).collect()
    dated = [F.col("ORDER_DATE_KEY").between(F.lit(span["FIRST"]), F.lit(span["LAST"])) for span in spans]
    return monthly_revenue(fact_sales.filter(reduce(Column.__or__, dated, F.lit(False))), days)


def build(star: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All published views over a star schema given by table name."""
    sales, returned = star["FACT_SALES"], star["FACT_RETURNS"]
    day, product = star["DIM_DATE"], star["DIM_PRODUCT"]
    customer, territory = star["DIM_CUSTOMER"], star["DIM_TERRITORY"]
    return {
        "VW_SALES_DETAIL": sales_detail(sales, day, product, customer, territory),
        "VW_MONTHLY_KPI": monthly_kpi(sales, day),
        "VW_PRODUCT_PERFORMANCE": product_performance(sales, product, returned),
        "VW_CUSTOMER_360": customer_360(sales, customer),
        "VW_TERRITORY_SUMMARY": territory_summary(sales, territory),
        "VW_RETURN_ANALYSIS": return_analysis(returned, product, territory, day),
    }


def register(star: dict[str, DataFrame]) -> list[str]:
    """Create or replace a temporary view per published view; returns their names."""
    views = build(star)
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)
    return list(views)


