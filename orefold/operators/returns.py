"""Product totals of sales and returns, joined without multiplying rows.

The published return-rate queries join the two facts on the product alone, so every sale of a product meets every
return of it. Sums over those pairs follow from one total per product and fact:

* a sales sum appears once per return of the product (once if there is none),
* a returns sum appears once per sale of the product.

``paired`` gives these sums without ever building a pair; ``per_product`` gives the plain ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sales_totals(fact_sales: DataFrame) -> DataFrame:
    return fact_sales.groupBy("PRODUCT_KEY").agg(
        F.count(F.lit(1)).alias("SALE_ROWS"),
        F.sum("ORDER_QUANTITY").alias("SOLD"),
        F.sum("GROSS_REVENUE").alias("REVENUE"),
        F.sum("GROSS_PROFIT").alias("PROFIT"),
    )


def return_totals(fact_returns: DataFrame) -> DataFrame:
    return fact_returns.groupBy("PRODUCT_KEY").agg(
        F.count(F.lit(1)).alias("RETURN_ROWS"),
        F.sum("RETURN_QUANTITY").alias("RETURNED"),
        F.sum("RETURN_REVENUE_IMPACT").alias("IMPACT"),
    )


def _times(total: Column, rows: Column, scale: int) -> Column:
    """Product in 38 digits: totals of pairs outgrow a long on large tables."""
    return (total.cast(f"decimal({20 + scale},{scale})") * rows.cast("decimal(17,0)")).cast(f"decimal(38,{scale})")


def per_product(fact_sales: DataFrame, fact_returns: DataFrame) -> DataFrame:
    """One row per sold product; returned amounts are null where nothing came back."""
    return sales_totals(fact_sales).join(return_totals(fact_returns), "PRODUCT_KEY", "left")


def paired(fact_sales: DataFrame, fact_returns: DataFrame) -> DataFrame:
    """As ``per_product`` with every total multiplied as the row-by-row join would."""
    repeats = F.coalesce(F.col("RETURN_ROWS"), F.lit(1))
    return per_product(fact_sales, fact_returns).select(
        "PRODUCT_KEY",
        _times(F.col("SOLD"), repeats, 0).alias("SOLD"),
        _times(F.col("REVENUE"), repeats, 2).alias("REVENUE"),
        _times(F.col("PROFIT"), repeats, 2).alias("PROFIT"),
        _times(F.col("RETURNED"), F.col("SALE_ROWS"), 0).alias("RETURNED"),
        _times(F.col("IMPACT"), F.col("SALE_ROWS"), 2).alias("IMPACT"),
    )


def paired_from_returns(fact_sales: DataFrame, fact_returns: DataFrame) -> DataFrame:
    """The same pairs seen from the returns: products without a sale stay, with nothing sold."""
    repeats = F.coalesce(F.col("SALE_ROWS"), F.lit(1))
    return return_totals(fact_returns).join(sales_totals(fact_sales), "PRODUCT_KEY", "left").select(
        "PRODUCT_KEY",
        _times(F.col("RETURNED"), repeats, 0).alias("RETURNED"),
        _times(F.col("SOLD"), F.col("RETURN_ROWS"), 0).alias("SOLD"),
    )
