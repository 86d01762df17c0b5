"""The test tables seen as raw files, curated tables and a star schema.

``lineitem`` holds the sales lines, ``orders`` their dates and customers, ``part`` the products, ``customer`` and
``nation`` the people and places, ``events`` the query log. Raw tables carry the defects that the cleansing steps are
for: mixed date formats, missing-value tokens, unknown products, blank names. All expressions are exact.

``fact_sales`` takes the columns a query needs and joins only what supplies them. The joins it leaves out are left
joins on unique keys, so leaving them out changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orefold import schemas
from orefold.operators import gold, silver
from orefold.sources import versions

AS_OF = date(2002, 1, 1)

# Stands for the yearly files: which return flag goes to which year.
YEAR_OF_FLAG = {"A": 2020, "N": 2021, "R": 2022}

_TABLES = ("region", "nation", "customer", "part", "orders", "lineitem", "events")
_CATEGORY_KEYS = {"ECONOMY": 1, "LARGE": 2, "MEDIUM": 3, "PROMO": 4, "SMALL": 5, "STANDARD": 6}
_PRICED = {"UNIT_PRICE", "UNIT_COST", "GROSS_REVENUE", "TOTAL_COST", "GROSS_PROFIT", "MARGIN_PCT"}
_DATED = {"ORDER_DATE_KEY", "SALES_YEAR", "LEAD_TIME_DAYS"}


def _choice(key: Column, *values) -> Column:
    """Value number ``key`` modulo the number of values; None is a null."""
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (key % len(values) + 1).cast("int"))


def _keyed(name: Column) -> Column:
    key = F.lit(None).cast("long")
    for label, number in _CATEGORY_KEYS.items():
        key = F.when(name == label, F.lit(number).cast("long")).otherwise(key)
    return key


def _kept(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Define a table once per feed. What is kept is the lazy definition, not rows."""

    @wraps(build)
    def once(self: StarFeed, *args):
        key = (build.__name__, args)
        if key not in self._defined:
            self._defined[key] = build(self, *args)
        return self._defined[key]

    return once


def _dated(lines: DataFrame) -> DataFrame:
    return lines.withColumns(
        {
            "SALES_YEAR": F.year("ORDER_DATE_KEY"),
            "LEAD_TIME_DAYS": F.datediff("ORDER_DATE_KEY", "STOCK_DATE_KEY").cast("long"),
        }
    )


def completed_sales(priced: DataFrame) -> DataFrame:
    """The sales fact from its priced lines, row by row."""
    return gold.measure_sales(_dated(priced)).select(*schemas.GOLD["FACT_SALES"].names)


class StarFeed:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._defined: dict[tuple, DataFrame] = {}

    @_kept
    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    @_kept
    def stored_bytes(self) -> int:
        return sum(versions.stored_bytes(self.spark, f"{self.folder}/{name}.parquet") for name in _TABLES)

    # Raw layer

    @_kept
    def raw_calendar(self) -> DataFrame:
        """Every day of the years in which orders were placed."""
        span = self.table("orders").agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
        first = F.trunc("first", "year")
        last = F.last_day(F.add_months(F.trunc("last", "year"), 11))
        days = span.filter(F.col("first").isNotNull()).select(F.explode(F.sequence(first, last)).alias("day"))
        return days.select(F.date_format("day", "yyyy-MM-dd").alias("DATE"))

    @_kept
    def raw_territory(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
            F.col("n_nationkey").cast("long").alias("SALESTERRITORYKEY"),
            F.when(~F.col("n_nationkey").isin(10, 11), F.lower("n_name")).alias("REGION"),
            F.concat(F.lit(" "), F.upper("n_name")).alias("COUNTRY"),
            F.col("r_name").alias("CONTINENT"),
        )

    @_kept
    def _part(self) -> DataFrame:
        return self.table("part").withColumns(
            {
                "category_key": _keyed(F.col("p_type")),
                "brand": F.expr("try_cast(substring(p_brand, 7) AS BIGINT)"),
            }
        )

    @_kept
    def raw_category(self) -> DataFrame:
        named = self._part().select(
            F.col("category_key").alias("PRODUCTCATEGORYKEY"), F.concat("p_type", F.lit(" ")).alias("CATEGORYNAME")
        )
        return named.distinct()

    @_kept
    def raw_subcategory(self) -> DataFrame:
        """Category 6 has no subcategories."""
        part = self._part().filter(F.col("category_key") != 6)
        key = (F.col("category_key") * 1000 + F.col("brand")).alias("PRODUCTSUBCATEGORYKEY")
        return part.select(
            key, F.col("p_brand").alias("SUBCATEGORYNAME"), F.col("category_key").alias("PRODUCTCATEGORYKEY")
        ).distinct()

    def raw_product(self) -> DataFrame:
        return self._named_product().select(*schemas.BRONZE["BRONZE_PRODUCT"].names)

    @_kept
    def _named_product(self) -> DataFrame:
        """The raw table with the names that its lookups would give."""
        key = F.col("p_partkey")
        price = (F.col("p_retailprice").cast("decimal(12,4)") * F.col("p_size") * F.lit("0.04").cast("decimal(2,2)")).cast(
            "decimal(12,4)"
        )
        percent = (key % 70 + 40).cast("decimal(3,0)")
        cost = (F.col("PRODUCTPRICE") * percent * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(12,4)")
        words = F.split("p_name", " ")
        return (
            self._part()
            .withColumn("PRODUCTPRICE", price)
            .select(
                key.alias("PRODUCTKEY"),
                (F.col("category_key") * 1000 + F.col("brand")).alias("PRODUCTSUBCATEGORYKEY"),
                F.concat(F.lit(" SKU-"), key).alias("PRODUCTSKU"),
                F.col("p_name").alias("PRODUCTNAME"),
                F.try_element_at(words, F.lit(2)).alias("MODELNAME"),
                F.concat("p_name", F.lit(" by "), "p_brand").alias("PRODUCTDESCRIPTION"),
                F.when(F.col("p_size") % 10 == 0, "0").otherwise(F.concat(words[0], F.lit(" "))).alias("PRODUCTCOLOR"),
                F.when(key % 9 == 0, "0").otherwise(F.col("p_size").cast("string")).alias("PRODUCTSIZE"),
                _choice(key, "U", None, "0", "W").alias("PRODUCTSTYLE"),
                cost.alias("PRODUCTCOST"),
                "PRODUCTPRICE",
                "p_type",
                "p_brand",
                F.col("category_key").alias("part_category"),
            )
        )

    @_kept
    def raw_customer(self) -> DataFrame:
        key = F.col("c_custkey")
        born = F.date_add(F.lit(date(1940, 1, 1)), (key * 7 % 25000).cast("int"))
        return self.table("customer").select(
            key.alias("CUSTOMERKEY"),
            _choice(key, "MR. ", "MRS.", None).alias("PREFIX"),
            F.upper(F.split_part("c_name", F.lit("#"), F.lit(1))).alias("FIRSTNAME"),
            F.concat(F.lit(" "), F.split_part("c_name", F.lit("#"), F.lit(2))).alias("LASTNAME"),
            F.when(key % 11 == 0, F.date_format(born, "M/d/yyyy"))
            .otherwise(F.date_format(born, "yyyy-MM-dd"))
            .alias("BIRTHDATE"),
            _choice(key, "M", "S", "X").alias("MARITALSTATUS"),
            _choice(key, "M", "F", "Male", "Female", None).alias("GENDER"),
            F.concat(F.translate("c_name", "#", ""), F.lit("@Example.com ")).alias("EMAILADDRESS"),
            F.when(F.col("c_acctbal") >= 0, F.round(F.col("c_acctbal") * 15).cast("long")).alias("ANNUALINCOME"),
            F.when(key % 6 > 0, key % 6).alias("TOTALCHILDREN"),
            _choice(key, "Bachelors", "High School ", None, "Graduate Degree").alias("EDUCATIONLEVEL"),
            F.initcap("c_mktsegment").alias("OCCUPATION"),
            _choice(key, "Y", "N", None).alias("HOMEOWNER"),
        )

    @_kept
    def _territory_of_order(self) -> DataFrame:
        """Order date, customer and territory by order key."""
        home = self.table("customer").select(
            F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("long").alias("TERRITORYKEY")
        )
        return self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate").join(home, "o_custkey", "left")

    @_kept
    def raw_sales(self, flag: str | None = None) -> DataFrame:
        """Raw sales lines, all or those of one yearly file.

        Dates come in three formats and sometimes as garbage; some order numbers and quantities are missing.
        """
        lines = self.table("lineitem")
        if flag is not None:
            lines = lines.filter(F.col("l_returnflag") == flag)
        key, ordered = F.col("l_orderkey"), F.col("o_orderdate").cast("date")
        wanted = lines.select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate", "l_returnflag"
        )
        joined = wanted.join(self._territory_of_order(), F.col("l_orderkey") == F.col("o_orderkey"), "left")
        return joined.select(
            F.when(key % 50 == 9, "bad")
            .when(key % 10 == 8, F.date_format(ordered, "M/d/yyyy"))
            .when(key % 10 == 9, F.date_format(ordered, "MM/dd/yyyy"))
            .otherwise(F.date_format(ordered, "yyyy-MM-dd"))
            .alias("ORDERDATE"),
            F.date_format("l_shipdate", "yyyy-MM-dd").alias("STOCKDATE"),
            F.when(key % 101 > 0, F.concat(F.lit("SO"), key)).alias("ORDERNUMBER"),
            F.when(key % 97 == 0, F.col("l_partkey") + 1_000_000_000_000)
            .otherwise(F.col("l_partkey"))
            .alias("PRODUCTKEY"),
            F.col("o_custkey").alias("CUSTOMERKEY"),
            "TERRITORYKEY",
            F.col("l_linenumber").cast("long").alias("ORDERLINEITEM"),
            F.when(~((key % 10 == 0) & (F.col("l_linenumber") == 7)), F.col("l_quantity").cast("long")).alias(
                "ORDERQUANTITY"
            ),
            F.col("l_shipdate").alias("LOAD_TIMESTAMP"),
            F.concat(F.lit("sales-"), "l_returnflag", F.lit(".csv")).alias("SOURCE_FILE"),
        )

    def yearly_sales(self) -> list[tuple[int, DataFrame]]:
        return [(year, self.raw_sales(flag)) for flag, year in YEAR_OF_FLAG.items()]

    @_kept
    def sales_of_years(self) -> DataFrame:
        """The yearly files under one another, from one scan, with the year as a column."""
        year = F.lit(None).cast("int")
        for flag, number in YEAR_OF_FLAG.items():
            year = F.when(F.col("SOURCE_FILE") == f"sales-{flag}.csv", number).otherwise(year)
        return self.raw_sales().withColumn(silver.FILE_YEAR, year).filter(F.col(silver.FILE_YEAR).isNotNull())

    @_kept
    def raw_returns(self) -> DataFrame:
        """Some returns name an unknown product, some have a date that does not parse."""
        key = F.col("l_orderkey")
        lines = self.table("lineitem").filter(F.col("l_returnflag") == "R")
        shipped = lines.select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate").join(
            self._territory_of_order().select("o_orderkey", "TERRITORYKEY"), key == F.col("o_orderkey"), "left"
        )
        return shipped.select(
            F.when(key % 40 == 3, F.date_format("l_shipdate", "M/d/yyyy"))
            .when(key % 40 != 7, F.date_format("l_shipdate", "yyyy-MM-dd"))
            .alias("RETURNDATE"),
            "TERRITORYKEY",
            F.when(key % 50 == 0, F.col("l_partkey") + 1_000_000_000_000)
            .otherwise(F.col("l_partkey"))
            .alias("PRODUCTKEY"),
            F.when(key % 30 > 0, F.col("l_quantity").cast("long")).alias("RETURNQUANTITY"),
        )

    @_kept
    def raw_category_sales(self) -> DataFrame:
        """Units per ship date and category, one column per region; no sale is a null."""
        lines = self.table("lineitem").select("l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
        part = self.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
        region = {0: "NORTH_REGION", 1: "CENTRAL_REGION", 2: "SOUTH_REGION"}
        return (
            lines.join(part, "l_partkey")
            .groupBy(F.date_format("l_shipdate", "M/d/yyyy").alias("DATE"), F.col("p_type").alias("PRODUCT_CATEGORY"))
            .agg(
                *[
                    F.sum(F.when(F.col("l_suppkey") % 3 == n, F.col("l_quantity").cast("long"))).alias(name)
                    for n, name in region.items()
                ]
            )
        )

    def raw_tables(self) -> dict[str, DataFrame]:
        """By short names; SALES stands for all years."""
        return {
            "SALES": self.raw_sales(),
            **{f"SALES_{year}": df for year, df in self.yearly_sales()},
            "CATEGORY_SALES_UNPIVOT": self.raw_category_sales(),
            "CUSTOMER": self.raw_customer(),
            "PRODUCT": self.raw_product(),
            "TERRITORY": self.raw_territory(),
            "CALENDAR": self.raw_calendar(),
            "RETURNS": self.raw_returns(),
            "PRODUCT_CATEGORY": self.raw_category(),
            "SUBCATEGORY": self.raw_subcategory(),
        }

    # Curated layer and dimensions

    @_kept
    def calendar(self) -> DataFrame:
        return silver.calendar(self.raw_calendar())

    @_kept
    def territory(self) -> DataFrame:
        """Complete names, without the blanks of the raw table."""
        nation, region = self.table("nation"), self.table("region")
        clean = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
            F.col("n_nationkey").alias("SALESTERRITORYKEY"),
            F.col("n_name").alias("REGION"),
            F.col("n_name").alias("COUNTRY"),
            F.col("r_name").alias("CONTINENT"),
        )
        return silver.territory(clean)

    @_kept
    def product(self) -> DataFrame:
        """Category names straight from the part row instead of the lookup tables."""
        named = self._named_product().withColumns(
            {"SUBCATEGORYNAME": F.col("p_brand"), "CATEGORYNAME": F.col("p_type"), "CATEGORY_KEY": F.col("part_category")}
        )
        return silver.named_product(named)

    @_kept
    def customer(self) -> DataFrame:
        return silver.customer(self.raw_customer(), AS_OF)

    @property
    @_kept
    def dim_date(self) -> DataFrame:
        return gold.dim_date(self.calendar())

    @property
    @_kept
    def dim_territory(self) -> DataFrame:
        return gold.dim_territory(self.territory())

    @property
    @_kept
    def dim_product(self) -> DataFrame:
        return gold.dim_product(self.product())

    @property
    @_kept
    def dim_customer(self) -> DataFrame:
        return gold.dim_customer(self.customer())

    # Facts

    @_kept
    def _sales_lines(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("ORDER_NUMBER"),
            F.col("l_linenumber").cast("long").alias("ORDER_LINE_ITEM"),
            F.col("l_partkey").alias("PRODUCT_KEY"),
            F.col("l_quantity").cast("long").alias("ORDER_QUANTITY"),
            F.col("l_shipdate").cast("date").alias("STOCK_DATE_KEY"),
        )

    def _with_order(self, lines: DataFrame, needed: set[str]) -> DataFrame:
        """Join ``orders`` and ``customer`` if a column needs them; a line without its order keeps nulls."""
        return _dated(self._with_header(lines, needed)) if needed & _DATED else self._with_header(lines, needed)

    def _with_header(self, lines: DataFrame, needed: set[str]) -> DataFrame:
        if not needed & (_DATED | {"CUSTOMER_KEY", "TERRITORY_KEY"}):
            return lines
        header = self.table("orders").select(
            F.col("o_orderkey").alias("ORDER_NUMBER"),
            F.col("o_custkey").alias("CUSTOMER_KEY"),
            F.col("o_orderdate").cast("date").alias("ORDER_DATE_KEY"),
        )
        if "TERRITORY_KEY" in needed:
            home = self.table("customer").select(
                F.col("c_custkey").alias("CUSTOMER_KEY"), F.col("c_nationkey").cast("long").alias("TERRITORY_KEY")
            )
            header = header.join(home, "CUSTOMER_KEY", "left")
        return lines.join(header, "ORDER_NUMBER", "left")

    @_kept
    def priced_sales(self) -> DataFrame:
        """The whole sales fact but for the columns that follow from others of a line; ``completed_sales`` adds them."""
        return gold.list_prices(self._with_header(self._sales_lines(), {"TERRITORY_KEY"}), self.dim_product)

    @_kept
    def fact_sales(self, *columns: str) -> DataFrame:
        """Sales fact with the given columns, all by default.

        Prices are joined before the order, so the result is distributed by order and counting orders needs no
        further shuffle of the lines. The whole fact gets its prices last: what is shuffled has no measures yet, and the
        result is distributed by product, as labels of products need it.
        """
        if not columns:
            return completed_sales(self.priced_sales())
        needed = set(columns)
        lines = self._sales_lines()
        priced = gold.price_sales(lines, self.dim_product) if needed & _PRICED else lines
        return self._with_order(priced, needed).select(*columns)

    @_kept
    def fact_returns(self, *columns: str) -> DataFrame:
        """Returned lines; territory is joined only if asked for."""
        columns = columns or tuple(schemas.GOLD["FACT_RETURNS"].names)
        lines = (
            self.table("lineitem")
            .filter(F.col("l_returnflag") == "R")
            .select(
                F.col("l_orderkey").alias("ORDER_NUMBER"),
                F.col("l_shipdate").cast("date").alias("RETURN_DATE"),
                F.col("l_partkey").alias("PRODUCT_KEY"),
                F.col("l_quantity").cast("long").alias("RETURN_QUANTITY"),
            )
        )
        if "TERRITORY_KEY" in columns:
            header = self._territory_of_order().select(
                F.col("o_orderkey").alias("ORDER_NUMBER"), F.col("TERRITORYKEY").alias("TERRITORY_KEY")
            )
            lines = lines.join(header, "ORDER_NUMBER", "left")
        else:
            lines = lines.withColumn("TERRITORY_KEY", F.lit(None).cast("long"))
        return gold.fact_returns(lines, self.dim_product).select(*columns)

    def star(self) -> dict[str, DataFrame]:
        return {
            "DIM_DATE": self.dim_date,
            "DIM_CUSTOMER": self.dim_customer,
            "DIM_PRODUCT": self.dim_product,
            "DIM_TERRITORY": self.dim_territory,
            "FACT_SALES": self.fact_sales(),
            "FACT_RETURNS": self.fact_returns(),
        }

    # Log

    @_kept
    def query_log(self) -> DataFrame:
        credits = F.col("value").cast("decimal(18,4)")
        return self.table("events").select(
            F.col("event_id").alias("QUERY_ID"),
            F.concat(F.col("event_type"), F.lit(" "), F.repeat("props", F.lit(12))).alias("QUERY_TEXT"),
            (F.col("value") * 100).alias("TOTAL_ELAPSED_TIME"),
            (F.col("user_id") * 1_000_000).alias("BYTES_SCANNED"),
            credits.alias("CREDITS_USED"),
            (credits * F.lit("0.9").cast("decimal(2,1)")).cast("decimal(18,4)").alias("CREDITS_USED_COMPUTE"),
            (credits * F.lit("0.1").cast("decimal(2,1)")).cast("decimal(18,4)").alias("CREDITS_USED_CLOUD_SERVICES"),
            F.concat(F.lit("WH_"), F.col("user_id") % 7).alias("WAREHOUSE_NAME"),
            F.when(F.col("event_type") == "error", "FAIL").otherwise("SUCCESS").alias("EXECUTION_STATUS"),
            F.col("ts").alias("START_TIME"),
        )
