"""Curated tables to the star schema: four dimensions, two facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orefold import schemas
from orefold.functions import bands, dates


def dim_date(calendar: DataFrame) -> DataFrame:
    year, month = F.col("YEAR"), F.col("MONTH_NUM")
    return calendar.filter(F.col("DATE_KEY").isNotNull()).select(
        *schemas.SILVER["SILVER_CALENDAR"].names,
        dates.fiscal_year(year, month).alias("FISCAL_YEAR"),
        dates.fiscal_month(month).alias("FISCAL_MONTH"),
        F.concat(F.lit("FQ"), dates.fiscal_quarter(month)).alias("FISCAL_QUARTER"),
    )


def dim_customer(customer: DataFrame) -> DataFrame:
    """The latest state only: a refresh replaces all attributes."""
    return customer.select(*schemas.GOLD["DIM_CUSTOMER"].names)


def dim_product(product: DataFrame) -> DataFrame:
    tier = bands.banded(F.col("PRODUCT_PRICE"), bands.CATALOGUE_TIERS)
    return product.withColumn("PRICE_TIER", tier).select(*schemas.GOLD["DIM_PRODUCT"].names)


def dim_territory(territory: DataFrame) -> DataFrame:
    return territory.select(
        "TERRITORY_KEY", "REGION", "COUNTRY", "CONTINENT", bands.region_code(F.col("REGION")).alias("REGION_CODE")
    )


def _or_zero(column: str, type_name: str):
    return F.coalesce(F.col(column), F.lit(0).cast(type_name))


def price_sales(lines: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Add prices and measures to sales lines; a product that is not in the dimension is priced 0."""
    return measure_sales(list_prices(lines, dim_product))


def list_prices(lines: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Add what the dimension has to sales lines."""
    listed = dim_product.select(
        "PRODUCT_KEY",
        F.col("PRODUCT_PRICE").alias("UNIT_PRICE"),
        F.col("PRODUCT_COST").alias("UNIT_COST"),
        "MARGIN_PCT",
    )

    return lines.join(listed, "PRODUCT_KEY", "left").withColumns(
        {
            "UNIT_PRICE": _or_zero("UNIT_PRICE", "decimal(12,4)"),
            "UNIT_COST": _or_zero("UNIT_COST", "decimal(12,4)"),
            "MARGIN_PCT": _or_zero("MARGIN_PCT", "decimal(7,2)"),
        }
    )


def measure_sales(priced: DataFrame) -> DataFrame:
    """Add the measures, which follow from the other columns of a line."""
    quantity = F.col("ORDER_QUANTITY")
    price, cost = F.col("UNIT_PRICE"), F.col("UNIT_COST")

    def amount(value):
        return F.round(value, 2).cast("decimal(14,2)")

    return priced.withColumns(
        {
            "GROSS_REVENUE": amount(quantity * price),
            "TOTAL_COST": amount(quantity * cost),
            "GROSS_PROFIT": amount(quantity * price - quantity * cost),
        }
    )


def fact_sales(sales: DataFrame, dim_product: DataFrame) -> DataFrame:
    """One row per order line."""
    renamed = sales.withColumnsRenamed(
        {"ORDER_DATE": "ORDER_DATE_KEY", "STOCK_DATE": "STOCK_DATE_KEY", "DAYS_FROM_STOCK_TO_ORDER": "LEAD_TIME_DAYS"}
    )
    return price_sales(renamed, dim_product).select(*schemas.GOLD["FACT_SALES"].names)


def fact_returns(returns: DataFrame, dim_product: DataFrame) -> DataFrame:
    """One row per return record."""
    listed = dim_product.select("PRODUCT_KEY", F.col("PRODUCT_PRICE").alias("UNIT_PRICE"))
    price = _or_zero("UNIT_PRICE", "decimal(12,4)")
    return returns.join(listed, "PRODUCT_KEY", "left").select(
        F.col("RETURN_DATE").alias("RETURN_DATE_KEY"),
        "PRODUCT_KEY",
        "TERRITORY_KEY",
        "RETURN_QUANTITY",
        price.alias("UNIT_PRICE"),
        F.round(F.col("RETURN_QUANTITY") * price, 2).cast("decimal(14,2)").alias("RETURN_REVENUE_IMPACT"),
    )
