"""Raw tables to typed, cleansed tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orefold import schemas
from orefold.functions import bands, dates, numbers, text
from orefold.functions.dates import parse_date

REGION_COLUMNS = {"North": "NORTH_REGION", "Central": "CENTRAL_REGION", "South": "SOUTH_REGION"}


def calendar(raw: DataFrame) -> DataFrame:
    day = F.col("DATE_KEY")
    return (
        raw.select(parse_date(F.col("DATE")).alias("DATE_KEY"))
        .filter(day.isNotNull())
        .select(
            day,
            F.year(day).alias("YEAR"),
            F.month(day).alias("MONTH_NUM"),
            F.monthname(day).alias("MONTH_NAME"),
            F.dayofmonth(day).alias("DAY_OF_MONTH"),
            F.dayname(day).alias("DAY_OF_WEEK_NAME"),
            (F.dayofweek(day) - 1).alias("DAY_OF_WEEK_NUM"),
            F.quarter(day).alias("QUARTER_NUM"),
            F.concat(F.lit("Q"), F.quarter(day)).alias("QUARTER_NAME"),
            F.weekofyear(day).alias("WEEK_OF_YEAR"),
            dates.day_name_is_weekend(day).alias("IS_WEEKEND"),
            F.trunc(day, "month").alias("FIRST_DAY_OF_MONTH"),
            F.last_day(day).alias("LAST_DAY_OF_MONTH"),
        )
    )


def territory(raw: DataFrame) -> DataFrame:
    names = ("REGION", "COUNTRY", "CONTINENT")
    return raw.filter(F.col("SALESTERRITORYKEY").isNotNull()).select(
        F.col("SALESTERRITORYKEY").cast("long").alias("TERRITORY_KEY"),
        *[F.trim(text.title_case(F.col(name))).alias(name) for name in names],
    )


def product_category(categories: DataFrame, subcategories: DataFrame) -> DataFrame:
    """Category list with its subcategories; a category without any is kept."""
    return categories.join(subcategories, "PRODUCTCATEGORYKEY", "left").select(
        F.col("PRODUCTCATEGORYKEY").alias("CATEGORY_KEY"),
        F.trim("CATEGORYNAME").alias("CATEGORY_NAME"),
        F.col("PRODUCTSUBCATEGORYKEY").alias("SUBCATEGORY_KEY"),
        F.trim("SUBCATEGORYNAME").alias("SUBCATEGORY_NAME"),
    )


def product(raw: DataFrame, subcategories: DataFrame, categories: DataFrame) -> DataFrame:
    named = raw.join(
        subcategories.select("PRODUCTSUBCATEGORYKEY", "SUBCATEGORYNAME", "PRODUCTCATEGORYKEY"),
        "PRODUCTSUBCATEGORYKEY",
        "left",
    ).join(
        categories.select(
            F.col("PRODUCTCATEGORYKEY"), F.col("PRODUCTCATEGORYKEY").alias("CATEGORY_KEY"), F.col("CATEGORYNAME")
        ),
        "PRODUCTCATEGORYKEY",
        "left",
    )
    return named_product(named)


def named_product(raw: DataFrame) -> DataFrame:
    """Product rows that already carry SUBCATEGORYNAME, CATEGORYNAME and CATEGORY_KEY."""
    cost, price = F.col("PRODUCTCOST").cast("decimal(12,4)"), F.col("PRODUCTPRICE").cast("decimal(12,4)")
    margin = (price - cost).cast("decimal(12,4)")
    return raw.filter(F.col("PRODUCTKEY").isNotNull()).select(
        F.col("PRODUCTKEY").alias("PRODUCT_KEY"),
        F.col("PRODUCTSUBCATEGORYKEY").alias("SUBCATEGORY_KEY"),
        F.trim("PRODUCTSKU").alias("PRODUCT_SKU"),
        F.trim("PRODUCTNAME").alias("PRODUCT_NAME"),
        F.trim("MODELNAME").alias("MODEL_NAME"),
        F.trim("PRODUCTDESCRIPTION").alias("PRODUCT_DESCRIPTION"),
        text.or_default(F.col("PRODUCTCOLOR"), "Unknown", missing="0").alias("PRODUCT_COLOR"),
        text.or_default(F.col("PRODUCTSIZE"), "N/A", missing="0").alias("PRODUCT_SIZE"),
        text.or_default(F.col("PRODUCTSTYLE"), "N/A", missing="0").alias("PRODUCT_STYLE"),
        cost.alias("PRODUCT_COST"),
        price.alias("PRODUCT_PRICE"),
        margin.alias("GROSS_MARGIN"),
        numbers.percent(margin, price).cast("decimal(7,2)").alias("MARGIN_PCT"),
        F.col("SUBCATEGORYNAME").alias("SUBCATEGORY_NAME"),
        F.col("CATEGORYNAME").alias("CATEGORY_NAME"),
        F.col("CATEGORY_KEY"),
    )


def customer(raw: DataFrame, as_of: date | None = None) -> DataFrame:
    first, last = text.title_case(F.trim("FIRSTNAME")), text.title_case(F.trim("LASTNAME"))
    born = parse_date(F.col("BIRTHDATE"))
    return raw.filter(F.col("CUSTOMERKEY").isNotNull()).select(
        F.col("CUSTOMERKEY").alias("CUSTOMER_KEY"),
        F.trim("PREFIX").alias("PREFIX"),
        first.alias("FIRST_NAME"),
        last.alias("LAST_NAME"),
        F.concat(first, F.lit(" "), last).alias("FULL_NAME"),
        born.alias("BIRTH_DATE"),
        dates.years_between(born, dates.today(as_of)).alias("AGE"),
        bands.labelled(F.col("MARITALSTATUS"), bands.MARITAL_LABELS).alias("MARITAL_STATUS"),
        bands.labelled(F.col("GENDER"), bands.GENDER_LABELS).alias("GENDER"),
        F.lower(F.trim("EMAILADDRESS")).alias("EMAIL_ADDRESS"),
        F.coalesce(F.col("ANNUALINCOME"), F.lit(0)).cast("long").alias("ANNUAL_INCOME"),
        bands.banded(F.col("ANNUALINCOME"), bands.INCOME_BANDS).alias("INCOME_BAND"),
        F.coalesce(F.col("TOTALCHILDREN"), F.lit(0)).cast("long").alias("TOTAL_CHILDREN"),
        text.or_default(F.col("EDUCATIONLEVEL"), "Unknown").alias("EDUCATION_LEVEL"),
        text.or_default(F.col("OCCUPATION"), "Unknown").alias("OCCUPATION"),
        F.coalesce(F.col("HOMEOWNER") == "Y", F.lit(False)).alias("IS_HOME_OWNER"),
    )


FILE_YEAR = "FILE_YEAR"


def stack_years(yearly: Sequence[tuple[int, DataFrame]]) -> DataFrame:
    """Yearly raw tables under one another, with the year of the file as a column."""
    return reduce(DataFrame.unionByName, [raw.withColumn(FILE_YEAR, F.lit(year)) for year, raw in yearly])


def sales_of_years(raw: DataFrame) -> DataFrame:
    """Raw sales of all years with their FILE_YEAR; repeated order lines stay repeated."""
    return completed_sales(cleansed_sales(raw))


def completed_sales(cleansed: DataFrame) -> DataFrame:
    """Add what follows from the other columns of a line."""
    waited = dates.days_between(F.col("STOCK_DATE"), F.col("ORDER_DATE"))
    return cleansed.withColumn("DAYS_FROM_STOCK_TO_ORDER", waited).select(*schemas.SILVER["SILVER_SALES"].names)


def cleansed_sales(raw: DataFrame) -> DataFrame:
    """``sales_of_years`` but for the columns of ``completed_sales``."""
    ordered, stocked = parse_date(F.col("ORDERDATE")), parse_date(F.col("STOCKDATE"))
    return raw.filter(F.col("ORDERNUMBER").isNotNull()).select(
        F.col("ORDERNUMBER").alias("ORDER_NUMBER"),
        F.col("ORDERLINEITEM").alias("ORDER_LINE_ITEM"),
        ordered.alias("ORDER_DATE"),
        stocked.alias("STOCK_DATE"),
        F.col("PRODUCTKEY").alias("PRODUCT_KEY"),
        F.col("CUSTOMERKEY").alias("CUSTOMER_KEY"),
        F.col("TERRITORYKEY").alias("TERRITORY_KEY"),
        F.coalesce(F.col("ORDERQUANTITY"), F.lit(0)).cast("long").alias("ORDER_QUANTITY"),
        F.col(FILE_YEAR).alias("SALES_YEAR"),
        F.col("SOURCE_FILE"),
    )


def sales(yearly: Sequence[tuple[int, DataFrame]]) -> DataFrame:
    """All yearly sales tables under one another."""
    return sales_of_years(stack_years(yearly))


def returns(raw: DataFrame) -> DataFrame:
    """The filter looks at the raw text, so a date that does not parse stays as a null date."""
    return raw.filter(F.col("RETURNDATE").isNotNull()).select(
        parse_date(F.col("RETURNDATE")).alias("RETURN_DATE"),
        F.col("TERRITORYKEY").alias("TERRITORY_KEY"),
        F.col("PRODUCTKEY").alias("PRODUCT_KEY"),
        F.coalesce(F.col("RETURNQUANTITY"), F.lit(0)).cast("long").alias("RETURN_QUANTITY"),
    )


def unpivot_category_sales(wide: DataFrame) -> DataFrame:
    """One row per date, category and region; a missing amount counts as 0."""
    typed = wide.select(
        parse_date(F.col("DATE"), dates.SLASHED).alias("SALE_DATE"),
        F.trim("PRODUCT_CATEGORY").alias("PRODUCT_CATEGORY"),
        *[F.coalesce(F.col(column), F.lit(0)).cast("long").alias(region) for region, column in REGION_COLUMNS.items()],
    )
    return typed.unpivot(["SALE_DATE", "PRODUCT_CATEGORY"], list(REGION_COLUMNS), "REGION", "SALES_AMOUNT")
