"""Checks of the star schema and the documented repairs of raw data (dq001 to dq007)."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orefold import schemas
from orefold.functions import bands, dates, numbers, text
from orefold.operators.profiling import unmatched_rows

# Names of the checks (fixed values).
ORPHAN_CHECKS = {
    "PRODUCT_KEY": "Orphaned PRODUCT_KEY in FACT_SALES",
    "CUSTOMER_KEY": "Orphaned CUSTOMER_KEY in FACT_SALES",
    "TERRITORY_KEY": "Orphaned TERRITORY_KEY in FACT_SALES",
}
NEGATIVE_REVENUE = "Negative GROSS_REVENUE in FACT_SALES"
NULL_ORDER_DATE = "NULL ORDER_DATE_KEY in FACT_SALES"


def orphans(fact_sales: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Fact rows without a dimension row per key column; ``dimensions`` maps the key column to its table."""
    return _checked(fact_sales, dimensions, {})


_PASSED = "PASSED"


def _checked(fact_sales: DataFrame, dimensions: Mapping[str, DataFrame], rows: Mapping[str, Column]) -> DataFrame:
    """Key checks and row conditions in one pass over the fact: a row that meets a condition has no key for it."""
    keys = {ORPHAN_CHECKS[key]: F.col(key) for key in dimensions}
    conditions = {name: F.when(F.coalesce(condition, F.lit(False)), None).otherwise(_PASSED) for name, condition in rows.items()}
    known = [(dimension, {ORPHAN_CHECKS[key]: F.col(key)}) for key, dimension in dimensions.items()]
    if rows:
        passed = fact_sales.sparkSession.range(1)
        known.append((passed, {name: F.lit(_PASSED) for name in rows}))
    found = unmatched_rows([(fact_sales, {**keys, **conditions})], known)
    return found.select(F.col("LABEL").alias("CHECK_NAME"), F.col("ORPHAN_ROWS").alias("FAILED_ROWS"))


def _row_checks(fact_sales: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """All row conditions in one pass."""
    counts = F.array(
        *[
            F.struct(F.lit(name).alias("CHECK_NAME"), F.count_if(condition).alias("FAILED_ROWS"))
            for name, condition in checks.items()
        ]
    )
    return fact_sales.agg(counts.alias("CHECKS")).select(F.inline("CHECKS"))


def negative_revenue(fact_sales: DataFrame) -> DataFrame:
    return _row_checks(fact_sales, {NEGATIVE_REVENUE: F.col("GROSS_REVENUE") < 0})


def null_order_date(fact_sales: DataFrame) -> DataFrame:
    return _row_checks(fact_sales, {NULL_ORDER_DATE: F.col("ORDER_DATE_KEY").isNull()})


def report(fact_sales: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """All checks with PASS or WARN each, and whether all passed; one pass over the fact."""
    checked = _checked(
        fact_sales,
        dimensions,
        {NEGATIVE_REVENUE: F.col("GROSS_REVENUE") < 0, NULL_ORDER_DATE: F.col("ORDER_DATE_KEY").isNull()},
    )
    verdicts = checked.agg(F.collect_list(F.struct("CHECK_NAME", "FAILED_ROWS")).alias("CHECKS"))
    all_passed = F.forall("CHECKS", lambda c: c["FAILED_ROWS"] == 0)
    return verdicts.select(all_passed.alias("ALL_PASSED"), F.inline("CHECKS")).withColumn(
        "STATUS", F.when(F.col("FAILED_ROWS") == 0, "PASS").otherwise("WARN")
    )


def required_columns(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Declared NOT NULL columns with their declared and actual type and the rows that break the rule; one pass per table."""

    def one(name: str, df: DataFrame) -> DataFrame:
        declared = schemas.TABLES[name]
        columns = F.array(
            *[
                F.struct(
                    F.lit(column).alias("COLUMN_NAME"),
                    F.lit(declared[column].dataType.simpleString()).alias("DECLARED_TYPE"),
                    F.lit(df.schema[column].dataType.simpleString()).alias("ACTUAL_TYPE"),
                    F.lit(df.schema[column].dataType == declared[column].dataType).alias("TYPE_MATCHES"),
                    F.count_if(F.col(column).isNull()).alias("NULL_ROWS"),
                )
                for column in schemas.required_columns(name)
            ]
        )
        return df.agg(columns.alias("COLUMNS")).select(F.lit(name).alias("TABLE_NAME"), F.inline("COLUMNS"))

    return reduce(DataFrame.unionByName, [one(name, df) for name, df in tables.items() if schemas.required_columns(name)])


_BUCKETS = 10_000


def _value_at(values: DataFrame, rank: int, low: int, high: int) -> int:
    """The value at a rank (from 1) of the whole numbers VALUE between ``low`` and ``high``, by repeated narrowing.

    Each pass counts the values of at most 10,000 equal parts of the range, combined before the shuffle, and goes on in the
    part that holds the rank until it is one value wide; a range of 64 bits takes five passes, whatever the distribution.
    """
    before = 0
    while low < high:
        width = (high - low) // _BUCKETS + 1
        inside = values.filter(F.col("VALUE").between(low, high))
        # The distance to the lower end of the range may exceed 64 bits, the number of the part does not.
        kind = "decimal(20,0)" if high - low > 2**62 else "bigint"
        part = F.call_function("div", F.col("VALUE").cast(kind) - F.lit(low).cast(kind), F.lit(width).cast(kind))
        upto = W.orderBy("PART").rowsBetween(W.unboundedPreceding, W.currentRow)
        counted = inside.groupBy(part.cast("bigint").alias("PART")).agg(F.count(F.lit(1)).alias("COPIES"))
        found = (
            counted.withColumn("LAST", F.sum("COPIES").over(upto))
            .filter(F.col("LAST") + before >= rank)
            .orderBy("PART")
            .first()
        )
        before += found["LAST"] - found["COPIES"]
        low += found["PART"] * width
        high = min(high, low + width - 1)
    return low


def exact_median(df: DataFrame, column: str) -> float | None:
    """Exact median of a whole-number column, null without values; no task gets all values or all distinct ones."""
    values = df.select(F.col(column).cast("long").alias("VALUE")).filter(F.col("VALUE").isNotNull())
    seen = values.agg(F.count(F.lit(1)).alias("N"), F.min("VALUE").alias("LOW"), F.max("VALUE").alias("HIGH")).first()
    if not seen["N"]:
        return None
    rank = (seen["N"] + 1) // 2
    lower = upper = _value_at(values, rank, seen["LOW"], seen["HIGH"])
    if seen["N"] % 2 == 0:
        above = values.agg(
            F.count_if(F.col("VALUE") <= lower).alias("UPTO"), F.min(F.when(F.col("VALUE") > lower, F.col("VALUE"))).alias("NEXT")
        ).first()
        upper = lower if above["UPTO"] > rank else above["NEXT"]
    return (lower + upper) / 2


def impute_income(customers: DataFrame) -> DataFrame:
    """dq001: a missing income becomes the median; its band stays Unknown."""
    median = F.round(F.lit(exact_median(customers, "ANNUALINCOME")).cast("double"), 0).cast("long")
    income = F.col("ANNUALINCOME")
    return customers.withColumn(
        "INCOME_BAND", F.when(income.isNull(), "Unknown").otherwise(bands.banded(income, bands.INCOME_BANDS))
    ).withColumn("ANNUALINCOME", F.coalesce(income, median))


def unify_dates(sales: DataFrame) -> DataFrame:
    """dq002: order dates in any of the known formats."""
    return sales.withColumn("ORDER_DATE", dates.parse_any_date(F.col("ORDERDATE")))


def flag_margin(products: DataFrame) -> DataFrame:
    """dq003: mark products that cost more than they sell for."""
    negative = F.col("PRODUCT_COST") > F.col("PRODUCT_PRICE")
    return products.withColumn("MARGIN_FLAG", F.when(negative, "NEGATIVE"))


def category_margins(flagged: DataFrame) -> DataFrame:
    """Mean margin per category without and with the marked products."""
    usable = F.when(F.col("MARGIN_FLAG").isNull(), F.col("MARGIN_PCT"))
    return flagged.groupBy("CATEGORY_NAME").agg(
        F.count(F.lit(1)).alias("PRODUCTS"),
        F.count("MARGIN_FLAG").alias("NEGATIVE_PRODUCTS"),
        numbers.mean2(usable).alias("AVG_MARGIN_PCT"),
        numbers.mean2(F.col("MARGIN_PCT")).alias("AVG_MARGIN_PCT_ALL"),
    )


def name_unknown_products(returns: DataFrame, dim_product: DataFrame) -> DataFrame:
    """dq004: returns of products that are not in the catalogue keep a row, named UNKNOWN."""
    return returns.join(dim_product.select("PRODUCT_KEY", "PRODUCT_NAME"), "PRODUCT_KEY", "left").withColumn(
        "PRODUCT_NAME", F.coalesce(F.col("PRODUCT_NAME"), F.lit("UNKNOWN"))
    )


def latest_order_lines(sales: DataFrame) -> DataFrame:
    """dq005: the most recently loaded row per order and line; the other columns break ties.

    A maximum is combined before the shuffle, so one order line with very many copies is no bottleneck.
    """
    keys = ("ORDERNUMBER", "ORDERLINEITEM")
    rest = [c for c in sales.columns if c not in (*keys, "LOAD_TIMESTAMP")]
    latest = F.max(F.struct("LOAD_TIMESTAMP", *rest)).alias("ROW")
    return sales.groupBy(*keys).agg(latest).select(*keys, "ROW.*")


def normalize_gender(customers: DataFrame) -> DataFrame:
    """dq006: four spellings to two labels."""
    return customers.withColumn("GENDER", bands.normalized_gender(F.col("GENDER")))


def fill_regions(territories: DataFrame, known: Mapping[int, str]) -> DataFrame:
    """dq007: blank regions of known territory keys."""
    region = F.col("REGION")
    filled = F.lit(None).cast("string")
    for key, name in known.items():
        filled = F.when(F.col("SALESTERRITORYKEY") == key, name).otherwise(filled)
    return territories.withColumn("REGION", F.when(text.is_blank(region), filled).otherwise(region))
