"""One query per operator over the test tables. Decimals leave as doubles, to compare with other engines."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import lru_cache, partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from orefold import schemas, session
from orefold.functions import dates, masks, numbers
from orefold.operators import gold, governance, layout, profiling, quality, silver
from orefold.plans import business, reports, views
from orefold.sources import delimited, history, tables
from orefold.sources.starfeed import AS_OF, StarFeed, completed_sales

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

VIEWER, ANALYST, ENGINEER = "VIEWER_ROLE", "ANALYST_ROLE", "DATA_ENGINEER_ROLE"

_MEASURES = ("ORDER_NUMBER", "ORDER_QUANTITY", "GROSS_REVENUE", "GROSS_PROFIT", "MARGIN_PCT")
_DATED = ("ORDER_DATE_KEY", *_MEASURES)


def without_decimals(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


@lru_cache(maxsize=8)
def feed_of(spark: SparkSession, sf_dir: str) -> StarFeed:
    """One feed per session and folder, so that queries share table definitions."""
    session.prepare(spark)
    return StarFeed(spark, sf_dir)


def query(build: Callable[[StarFeed], DataFrame]) -> Callable[[StarFeed], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        feed = feed_of(spark, sf_dir)
        session.fit_shuffles(spark, feed.stored_bytes)
        return without_decimals(build(feed))

    QUERIES[build.__name__] = run
    return build


def scratch(feed: StarFeed, label: str) -> str:
    return session.scratch_path(feed.spark, label)


def _stored(feed: StarFeed, name: str, df: DataFrame) -> DataFrame:
    """The table as stored, without its load time, which no two runs share."""
    return tables.refresh_table(feed.spark, scratch(feed, "stored"), name, df).drop(tables.LOAD_TIMESTAMP)


# Sources and stored tables


@query
def csv_scan(feed):
    path = scratch(feed, "csv")
    feed.raw_customer().write.option("header", True).csv(path)
    return delimited.scan(feed.spark, path, schemas.BRONZE["BRONZE_CUSTOMER"])


_ODD_FORMAT = delimited.Format(delimiter=";", quote="'", header=False)


@query
def csv_format_options(feed):
    key = F.col("o_orderkey")
    tokens = F.array(*[F.lit(t) for t in ("NULL", " null ", "N/A", "")])
    price = F.when(key % 5 == 0, tokens[(key % 4).cast("int")]).otherwise(F.col("o_custkey").cast("string"))
    quoted = F.concat(F.lit(" '"), F.col("o_orderpriority"), F.lit("; rush' "))
    path = scratch(feed, "format")
    feed.table("orders").select(F.concat_ws(";", key, quoted, price).alias("value")).write.text(path)
    declared = schemas.columns("ORDERKEY long, PRIORITY string, CUSTOMERKEY long")
    return delimited.scan(feed.spark, path, declared, _ODD_FORMAT)


@query
def csv_encoding(feed):
    path = scratch(feed, "latin1")
    name = F.concat(F.lit("José Müller "), F.col("c_custkey"))
    people = feed.table("customer").select(F.col("c_custkey").alias("CUSTOMERKEY"), name.alias("FIRSTNAME"))
    people.write.option("header", True).option("encoding", delimited.LATIN1).csv(path)
    found = delimited.detect_encoding(feed.spark, path)
    declared = schemas.columns("CUSTOMERKEY long, FIRSTNAME string")
    read = delimited.scan(feed.spark, path, declared, delimited.Format(encoding=found))
    return read.withColumn("ENCODING", F.lit(found))


@query
def normalize_columns(feed):
    headers = feed.table("customer").select(
        F.col("c_custkey").alias("Customer Key"),
        F.col("c_mktsegment").alias("Market Segment (Raw)"),
        F.col("c_name").alias("FullName"),
    )
    return delimited.normalize_columns(headers)


@query
def audit_columns(feed):
    path = scratch(feed, "audit")
    feed.table("orders").select("o_orderkey", "o_custkey").write.option("header", True).csv(path)
    read = feed.spark.read.schema("ORDERKEY long, CUSTOMERKEY long").option("header", True).csv(path)
    stamped = delimited.add_audit_columns(read)
    return stamped.select(
        "ORDERKEY",
        "CUSTOMERKEY",
        F.col("LOAD_TIMESTAMP").isNotNull().alias("HAS_LOAD_TIMESTAMP"),
        F.col("SOURCE_FILE").endswith(".csv").alias("HAS_SOURCE_FILE"),
    )


@query
def full_refresh_load(feed):
    path = scratch(feed, "refresh")
    orders = feed.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    tables.full_refresh(orders.filter(F.col("o_orderstatus") == "F"), path)
    tables.full_refresh(orders, path)
    return tables.read_table(feed.spark, path)


_LINE_FIELDS = "ORDERKEY long, LINE long, QUANTITY long, FLAG string"


def _defective_lines(feed) -> str:
    """Sales lines as text: some with a field too many or too few, some with a quantity that is no number."""
    key = F.col("l_orderkey")
    quantity = F.when(key % 31 == 0, "many").when(key % 29 == 0, "N/A").otherwise(F.col("l_quantity").cast("long").cast("string"))
    flag = F.when(key % 37 == 0, F.concat("l_returnflag", F.lit(",surplus"))).otherwise(F.col("l_returnflag"))
    full = F.concat_ws(",", key, "l_linenumber", quantity, flag)
    path = scratch(feed, "tolerant")
    line = F.when(key % 41 == 0, F.concat_ws(",", key, "l_linenumber")).otherwise(full)
    feed.table("lineitem").select(line.alias("value")).write.text(path)
    return path


def _tolerant(feed) -> tuple[DataFrame, DataFrame]:
    declared = schemas.columns(_LINE_FIELDS)
    return delimited.tolerant_load(feed.spark, _defective_lines(feed), declared, delimited.Format(header=False))


@query
def copy_into_tolerant(feed):
    return _tolerant(feed)[0]


@query
def copy_into_tolerant_rejects(feed):
    return _tolerant(feed)[1].groupBy(delimited.REASON).agg(F.count(F.lit(1)).alias("ROW_COUNT"))


def _source_files(feed, *missing: str) -> str:
    """A file for every registered table but the missing ones, with the columns in another order than declared."""
    folder = scratch(feed, "files")
    raw = {
        **{f"BRONZE_SALES_{year}": df for year, df in feed.yearly_sales()},
        "BRONZE_CUSTOMER": feed.raw_customer(),
        "BRONZE_PRODUCT": feed.raw_product(),
        "BRONZE_PRODUCT_CATEGORY": feed.raw_category(),
        "BRONZE_SUBCATEGORY": feed.raw_subcategory(),
        "BRONZE_CALENDAR": feed.raw_calendar(),
        "BRONZE_TERRITORY": feed.raw_territory(),
        "BRONZE_RETURNS": feed.raw_returns(),
        "BRONZE_CATEGORY_SALES_UNPIVOT": feed.raw_category_sales(),
    }

    def write(name: str, table: str) -> None:
        columns = schemas.BRONZE[table].names[::-1]
        raw[table].select(*columns).write.option("header", True).csv(f"{folder}/{name}")

    tables.side_by_side([partial(write, *entry) for entry in schemas.SOURCE_FILES.items() if entry[1] not in missing], 4)
    return folder


@query
def load_registry(feed):
    folder = _source_files(feed, "BRONZE_TERRITORY")
    return tables.load_sources(feed.spark, folder, scratch(feed, "bronze"))


@query
def files_to_sales_by_year(feed):
    """The whole chain: files, raw tables, curated tables, star schema, question."""
    root = scratch(feed, "bronze")
    tables.load_sources(feed.spark, _source_files(feed), root)

    def bronze(name: str) -> DataFrame:
        return tables.read_table(feed.spark, f"{root}/BRONZE_{name}")

    sales = silver.sales([(year, bronze(f"SALES_{year}")) for year in (2020, 2021, 2022)])
    product = silver.product(bronze("PRODUCT"), bronze("SUBCATEGORY"), bronze("PRODUCT_CATEGORY"))
    fact = gold.fact_sales(sales, gold.dim_product(product))
    stored = tables.refresh_table(feed.spark, scratch(feed, "gold"), "FACT_SALES", fact)
    return business.sales_by_year(stored, gold.dim_date(silver.calendar(bronze("CALENDAR"))))


def _silver_tables(feed) -> dict[str, DataFrame]:
    return {
        "SILVER_CALENDAR": feed.calendar(),
        "SILVER_TERRITORY": silver.territory(feed.raw_territory()),
        "SILVER_PRODUCT_CATEGORY": silver.product_category(feed.raw_category(), feed.raw_subcategory()),
        "SILVER_PRODUCT": silver.product(feed.raw_product(), feed.raw_subcategory(), feed.raw_category()),
        "SILVER_CUSTOMER": feed.customer(),
        "SILVER_SALES": silver.sales_of_years(feed.sales_of_years()),
        "SILVER_RETURNS": silver.returns(feed.raw_returns()),
        "SILVER_CATEGORY_SALES_UNPIVOT": silver.unpivot_category_sales(feed.raw_category_sales()),
    }


@query
def row_count_report(feed):
    built = {**_silver_tables(feed), **feed.star()}
    return tables.row_counts(built, scratch(feed, "layers"), feed.spark).drop("SECONDS")


@query
def ctas_refresh(feed):
    return _stored(feed, "FACT_SALES", feed.fact_sales())


@query
def declared_schema(feed):
    return quality.required_columns({**_silver_tables(feed), **feed.star()})


@query
def view_registry(feed):
    names = views.register(feed.star())
    counts = " UNION ALL ".join(f"SELECT '{n}' AS VIEW_NAME, count(*) AS ROW_COUNT FROM {n}" for n in names)
    return tables.query(feed.spark, counts)


@query
def mv_monthly_revenue(feed):
    """Built without the lines of the last 40 days, then refreshed for the months of these."""
    fact, path = feed.fact_sales(*_DATED), scratch(feed, "monthly")
    late = F.col("ORDER_DATE_KEY") > F.date_sub(F.lit(fact.agg(F.max("ORDER_DATE_KEY")).first()[0]), 40)
    early = fact.filter(~late)
    tables.refresh_monthly_revenue(path, early, feed.dim_date, early)
    tables.refresh_monthly_revenue(path, fact, feed.dim_date, fact.filter(late))
    return feed.spark.read.schema(views.monthly_revenue(fact, feed.dim_date).schema).parquet(path)


@query
def source_fallback(feed):
    names = ["FACT_SALES", "DIM_DATE"]
    found = tables.stored_or_built(feed.spark, scratch(feed, "absent"), names, feed.star)
    return reports.sales_by_year_sql(found["FACT_SALES"], found["DIM_DATE"])


@query
def query_to_table(feed):
    statement = """
        SELECT p.CATEGORY_NAME, COUNT(*) AS LINE_COUNT, SUM(f.ORDER_QUANTITY) AS UNITS_SOLD,
               ROUND(SUM(f.GROSS_REVENUE), 2) AS TOTAL_REVENUE
        FROM {sales} f JOIN {product} p ON f.PRODUCT_KEY = p.PRODUCT_KEY
        GROUP BY p.CATEGORY_NAME ORDER BY TOTAL_REVENUE DESC"""
    sales = feed.fact_sales("PRODUCT_KEY", "ORDER_QUANTITY", "GROSS_REVENUE")
    return tables.query(feed.spark, statement, sales=sales, product=feed.dim_product)


@query
def report_sink(feed):
    lines = tables.store(_report_lines(feed).select(*reports.REPORTED), "report-lines")
    datasets = {
        "sales_by_year": reports.sales_by_year(lines),
        "monthly_trend": reports.monthly_trend(lines),
        "category_revenue": reports.category_revenue(lines),
        "top_products": reports.top_products(lines),
        "territory": reports.territory(reports.with_places(lines, feed.raw_territory())),
        "customer_segment": reports.customer_segment(reports.with_people(lines, feed.raw_customer())),
        "returns": reports.returns(lines, feed.raw_returns()),
    }
    datasets = {name: df.withColumnRenamed("UNITS_RETURNED", "REVENUE") for name, df in datasets.items()}
    datasets["returns"] = datasets["returns"].withColumn("REVENUE", F.col("REVENUE").cast("decimal(28,2)"))
    written = tables.write_reports(feed.spark, datasets, scratch(feed, "reports"), ("csv", "json", "parquet"))
    read_back = [
        feed.spark.read.format(fmt)
        .option("header", True)
        .schema(datasets[name].schema)
        .load(folder)
        .agg(
            F.lit(name).alias("DATASET"),
            F.lit(fmt).alias("FORMAT"),
            F.count(F.lit(1)).alias("ROW_COUNT"),
            F.sum("REVENUE").alias("REVENUE"),
        )
        for (name, fmt), folder in written.items()
    ]
    return reduce(DataFrame.unionByName, read_back)


@query
def mapping_table_insert(feed):
    path = scratch(feed, "access")
    managers = feed.dim_territory.select(
        F.concat(F.lit("MANAGER_"), F.upper("CONTINENT")).alias("USER_NAME"), "TERRITORY_KEY"
    )
    managers.write.parquet(path)
    governance.access_table(feed.spark).write.mode("append").parquet(path)
    return feed.spark.read.parquet(path)


_STATES = tuple(datetime(year, 1, 1) for year in (1997, 1999, 2001))


def _order_history(feed, states=_STATES) -> str:
    """States of the orders table over time: what had been ordered by each date."""
    path = scratch(feed, "history")
    orders = feed.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    for taken in states:
        history.write_snapshot(orders.filter(F.col("o_orderdate") < F.lit(taken.date())), path, _ORDER_KEY, taken)
    return path


_ORDER_KEY = ["o_orderkey"]


@query
def point_in_time_read(feed):
    return history.read_as_of(feed.spark, _order_history(feed), _ORDER_KEY, datetime(2000, 6, 30)).drop("o_orderdate")


@query
def retention_filter(feed):
    """Snapshots within the retention of each layer, read after older states were deleted."""
    now = _STATES[-1]
    taken = [now - timedelta(days=days) for days in (60, 20, 10)]

    def kept(layer: str) -> DataFrame:
        path = _order_history(feed, taken)
        history.expire(feed.spark, path, _ORDER_KEY, layer, now)
        oldest = now - timedelta(days=schemas.RETENTION_DAYS[layer])
        counts = [
            history.read_as_of(feed.spark, path, _ORDER_KEY, moment)
            .agg(F.count(F.lit(1)).alias("ROW_COUNT"))
            .select(F.lit(history.stamp(moment)).alias(tables.SNAPSHOT), F.lit(layer).alias("LAYER"), "ROW_COUNT")
            for moment in taken
            if moment >= oldest
        ]
        return reduce(DataFrame.unionByName, counts)

    return reduce(DataFrame.unionByName, [kept(layer) for layer in schemas.RETENTION_DAYS])


# Curated tables


@query
def silver_calendar(feed):
    return feed.calendar()


@query
def silver_territory(feed):
    return silver.territory(feed.raw_territory())


@query
def silver_product_category(feed):
    return silver.product_category(feed.raw_category(), feed.raw_subcategory())


@query
def silver_product(feed):
    return silver.product(feed.raw_product(), feed.raw_subcategory(), feed.raw_category())


@query
def silver_customer(feed):
    return feed.customer()


@query
def silver_sales(feed):
    return silver.sales_of_years(feed.sales_of_years())


@query
def silver_returns(feed):
    return silver.returns(feed.raw_returns())


@query
def silver_unpivot(feed):
    return silver.unpivot_category_sales(feed.raw_category_sales())


# Star schema


@query
def dim_date(feed):
    return feed.dim_date


@query
def dim_customer(feed):
    return feed.dim_customer


@query
def dim_product(feed):
    return feed.dim_product


@query
def dim_territory(feed):
    return feed.dim_territory


@query
def fact_sales(feed):
    return feed.fact_sales()


@query
def fact_sales_from_silver(feed):
    """Through the cleansing steps: text dates, unknown products."""
    return gold.fact_sales(silver.sales_of_years(feed.sales_of_years()), feed.dim_product)


@query
def fact_returns(feed):
    return feed.fact_returns()


# Views


@query
def vw_sales_detail(feed):
    return views.sales_detail(
        feed.fact_sales(), feed.dim_date, feed.dim_product, feed.dim_customer, feed.dim_territory
    )


@query
def vw_monthly_kpi(feed):
    sales = feed.fact_sales("ORDER_LINE_ITEM", "TOTAL_COST", *_DATED)
    return views.monthly_kpi(sales, feed.dim_date)


def _product_facts(feed) -> tuple[DataFrame, DataFrame]:
    sales = feed.fact_sales("PRODUCT_KEY", "ORDER_QUANTITY", "GROSS_REVENUE", "GROSS_PROFIT")
    return sales, feed.fact_returns("PRODUCT_KEY", "RETURN_QUANTITY", "RETURN_REVENUE_IMPACT")


@query
def vw_product_performance(feed):
    sales, returned = _product_facts(feed)
    return views.product_performance(sales, feed.dim_product, returned)


@query
def vw_product_performance_safe(feed):
    sales, returned = _product_facts(feed)
    return views.product_performance_safe(sales, feed.dim_product, returned)


@query
def vw_customer_360(feed):
    return views.customer_360(feed.fact_sales("CUSTOMER_KEY", *_DATED), feed.dim_customer)


@query
def vw_territory_summary(feed):
    return views.territory_summary(feed.fact_sales("TERRITORY_KEY", *_MEASURES), feed.dim_territory)


@query
def vw_return_analysis(feed):
    return views.return_analysis(feed.fact_returns(), feed.dim_product, feed.dim_territory, feed.dim_date)


# Business questions


@query
def q01_sales_by_year(feed):
    return business.sales_by_year(feed.fact_sales(*_DATED), feed.dim_date)


@query
def q02_monthly_trend_mom(feed):
    return business.monthly_trend(feed.fact_sales(*_DATED), feed.dim_date)


@query
def q03_category_subcategory(feed):
    return business.category_subcategory(feed.fact_sales("PRODUCT_KEY", *_MEASURES), feed.dim_product)


@query
def q04_top10_products(feed):
    return business.top_products(feed.fact_sales("PRODUCT_KEY", *_MEASURES), feed.dim_product)


@query
def q05_customer_segments(feed):
    return business.customer_segments(feed.fact_sales("CUSTOMER_KEY", *_MEASURES), feed.dim_customer)


@query
def q06_geo_share(feed):
    return business.geography_share(feed.fact_sales("TERRITORY_KEY", *_MEASURES), feed.dim_territory)


@query
def q07_return_rate(feed):
    sales, returned = _product_facts(feed)
    return business.return_rate(sales, feed.dim_product, returned)


@query
def q07_return_rate_safe(feed):
    sales, returned = _product_facts(feed)
    return business.return_rate_safe(sales, feed.dim_product, returned)


@query
def q08_quarterly_yoy(feed):
    return business.quarterly_yoy(feed.fact_sales(*_DATED), feed.dim_date)


@query
def q09_clv_top20(feed):
    return business.customer_lifetime_value(feed.fact_sales("CUSTOMER_KEY", *_DATED), feed.dim_customer)


@query
def q10_pivot_regions(feed):
    return business.pivot_regions(silver.unpivot_category_sales(feed.raw_category_sales()))


@query
def q11_weekend_weekday(feed):
    return business.weekend_weekday(feed.fact_sales(*_DATED), feed.dim_date)


@query
def q12_running_ytd(feed):
    return business.running_ytd(feed.fact_sales(*_DATED), feed.dim_date)


@query
def q13_price_tier_mix(feed):
    return business.price_tier_mix(feed.fact_sales("PRODUCT_KEY", *_MEASURES), feed.dim_product)


@query
def q14_fiscal_quarter(feed):
    return business.fiscal_quarter(feed.fact_sales("TOTAL_COST", *_DATED), feed.dim_date)


@query
def q15_age_bands(feed):
    return business.age_bands(feed.fact_sales("CUSTOMER_KEY", *_MEASURES), feed.dim_customer, AS_OF)


# Reports


_PLACE = ("COUNTRY", "REGION")
_SEGMENT = ("OCCUPATION", "GENDER")


@lru_cache(maxsize=32)
def _report_lines(feed, *wanted: str) -> DataFrame:
    """Report lines with the wanted customer and territory columns."""
    return reports.enrich(
        feed.sales_of_years(),
        feed.raw_customer(),
        feed.raw_product(),
        feed.raw_subcategory(),
        feed.raw_category(),
        feed.raw_territory(),
        wanted,
    )


@query
def rpt_enrich(feed):
    return _report_lines(feed, *_PLACE, *_SEGMENT)


@query
def rpt_sales_by_year(feed):
    return reports.sales_by_year(_report_lines(feed))


@query
def rpt_sales_by_year_sql(feed):
    return reports.sales_by_year_sql(feed.fact_sales(*_DATED), feed.dim_date)


@query
def rpt_monthly_trend(feed):
    return reports.monthly_trend(_report_lines(feed))


@query
def rpt_monthly_trend_sql(feed):
    return reports.monthly_trend_sql(feed.fact_sales(*_DATED), feed.dim_date)


@query
def rpt_category_revenue(feed):
    return reports.category_revenue(_report_lines(feed))


@query
def rpt_category_revenue_sql(feed):
    return reports.category_revenue_sql(feed.fact_sales("PRODUCT_KEY", *_MEASURES), feed.dim_product)


@query
def rpt_top_products(feed):
    return reports.top_products(_report_lines(feed))


@query
def rpt_top_products_sql(feed):
    return reports.top_products_sql(feed.fact_sales("PRODUCT_KEY", *_MEASURES), feed.dim_product)


@query
def rpt_territory(feed):
    return reports.territory(_report_lines(feed, *_PLACE))


@query
def rpt_territory_sql(feed):
    return reports.territory_sql(feed.fact_sales("TERRITORY_KEY", *_MEASURES), feed.dim_territory)


@query
def rpt_customer_segment(feed):
    return reports.customer_segment(_report_lines(feed, *_SEGMENT))


@query
def rpt_customer_segment_sql(feed):
    return reports.customer_segment_sql(feed.fact_sales("CUSTOMER_KEY", *_MEASURES), feed.dim_customer)


@query
def rpt_returns(feed):
    return reports.returns(_report_lines(feed), feed.raw_returns())


@query
def rpt_returns_sql(feed):
    sales, returned = _product_facts(feed)
    return reports.returns_sql(sales, returned, feed.dim_product)


@query
def rpt_kpis(feed):
    lines, placed = _report_lines(feed), _report_lines(feed, *_PLACE)
    return reports.kpis(reports.sales_by_year(lines), reports.category_revenue(lines), reports.territory(placed))


@query
def fmt_money(feed):
    spent = feed.fact_sales("CUSTOMER_KEY", "GROSS_REVENUE").groupBy("CUSTOMER_KEY")
    return spent.agg(F.sum("GROSS_REVENUE").alias("REVENUE")).withColumn(
        "LABEL", numbers.money_label(F.col("REVENUE"))
    )


@query
def report_slices(feed):
    lines = _report_lines(feed)
    months = reports.first_months(reports.monthly_trend(lines)).select(
        F.lit("months").alias("SLICE"), F.concat_ws("-", "YEAR", "MONTH_NUM").alias("LABEL"), "REVENUE"
    )
    segments = reports.customer_segment(_report_lines(feed, *_SEGMENT))
    cuts = [
        reports.first_segments(segments, n).select(
            F.lit(f"segments_{n}").alias("SLICE"), F.concat_ws("/", "OCCUPATION", "GENDER").alias("LABEL"), "REVENUE"
        )
        for n in (20, 15)
    ]
    return reduce(DataFrame.unionByName, [months, *cuts])


@query
def chart_revenue_by_year(feed):
    return reports.chart_revenue_by_year(reports.sales_by_year(_report_lines(feed)))


@query
def chart_monthly_by_year(feed):
    return reports.chart_monthly_by_year(reports.monthly_trend(_report_lines(feed)))


@query
def chart_category_top8(feed):
    return reports.chart_top_categories(reports.category_revenue(_report_lines(feed)))


@query
def chart_category_share(feed):
    return reports.chart_category_share(reports.category_revenue(_report_lines(feed)))


@query
def chart_territory_top8(feed):
    return reports.chart_top_territories(reports.territory(_report_lines(feed, *_PLACE)))


@query
def chart_occupation(feed):
    return reports.chart_occupation(reports.customer_segment(_report_lines(feed, *_SEGMENT)))


@query
def chart_gender_share(feed):
    return reports.chart_gender_share(reports.customer_segment(_report_lines(feed, *_SEGMENT)))


@query
def chart_returns_top8(feed):
    return reports.chart_top_returns(reports.returns(_report_lines(feed), feed.raw_returns()))


# Profiles and quality


@query
def profile_nulls(feed):
    return profiling.null_profile(feed.raw_customer())


@query
def profile_numeric_hint(feed):
    return profiling.numeric_hint(feed.raw_sales().drop("LOAD_TIMESTAMP"))


@query
def profile_sample(feed):
    return profiling.sample(feed.raw_customer(), ["CUSTOMERKEY"])


@query
def profile_summary(feed):
    return profiling.summary(feed.raw_tables())


@query
def profile_table(feed):
    return profiling.table_profile(feed.raw_tables())


@query
def detect_duplicates(feed):
    raw = {f"BRONZE_SALES_{year}": df for year, df in feed.yearly_sales()}
    raw["BRONZE_CUSTOMER"] = feed.raw_customer()
    raw["BRONZE_TERRITORY"] = feed.raw_territory()
    raw["BRONZE_RETURNS"] = feed.raw_returns()
    raw["BRONZE_PRODUCT"] = feed.raw_product()
    raw["BRONZE_CALENDAR"] = feed.raw_calendar()
    raw["BRONZE_PRODUCT_CATEGORY"] = feed.raw_category()
    raw["BRONZE_SUBCATEGORY"] = feed.raw_subcategory()
    raw["BRONZE_CATEGORY_SALES_UNPIVOT"] = feed.raw_category_sales()
    return profiling.duplicate_groups(raw, schemas.UNIQUE_KEYS)


@query
def fk_relationship_check(feed):
    return profiling.foreign_key_report(feed.raw_tables(), schemas.FOREIGN_KEYS)


def _messy_fact(feed) -> DataFrame:
    return gold.fact_sales(silver.sales_of_years(feed.sales_of_years()), feed.dim_product)


def _dimensions(feed) -> dict[str, DataFrame]:
    return {
        "PRODUCT_KEY": feed.dim_product,
        "CUSTOMER_KEY": feed.dim_customer,
        "TERRITORY_KEY": feed.dim_territory,
    }


@query
def dq_orphans(feed):
    return quality.orphans(_messy_fact(feed), _dimensions(feed))


@query
def dq_negative_revenue(feed):
    return quality.negative_revenue(_messy_fact(feed))


@query
def dq_null_order_date(feed):
    return quality.null_order_date(_messy_fact(feed))


@query
def dq_report(feed):
    return quality.report(_messy_fact(feed), _dimensions(feed))


@query
def row_count_reconcile(feed):
    raw = {
        "SALES": feed.raw_sales(),
        "RETURNS": feed.raw_returns(),
        "CUSTOMER": feed.raw_customer(),
        "CALENDAR": feed.raw_calendar(),
        "PRODUCT_CATEGORY": feed.raw_category(),
        "PRODUCT": feed.raw_product(),
        "SUBCATEGORY": feed.raw_subcategory(),
        "CATEGORY_SALES_UNPIVOT": feed.raw_category_sales(),
    }
    loaded = {
        "PRODUCT": feed.product(),
        "CATEGORY_SALES_UNPIVOT": silver.unpivot_category_sales(feed.raw_category_sales()),
        "SALES": silver.sales_of_years(feed.sales_of_years()),
        "RETURNS": silver.returns(feed.raw_returns()),
        "CUSTOMER": feed.customer(),
        "CALENDAR": feed.calendar(),
        "TERRITORY": feed.territory(),
    }
    return profiling.reconcile(raw, loaded)


@query
def dq001_income_impute(feed):
    return quality.impute_income(feed.raw_customer()).select("CUSTOMERKEY", "ANNUALINCOME", "INCOME_BAND")


@query
def dq002_multi_format_date(feed):
    return quality.unify_dates(feed.raw_sales()).select("ORDERNUMBER", "ORDERLINEITEM", "ORDERDATE", "ORDER_DATE")


@query
def dq003_margin_flag(feed):
    return quality.flag_margin(feed.dim_product).select("PRODUCT_KEY", "MARGIN_PCT", "MARGIN_FLAG")


@query
def dq003_category_margins(feed):
    return quality.category_margins(quality.flag_margin(feed.dim_product))


@query
def dq004_unknown_product(feed):
    return quality.name_unknown_products(silver.returns(feed.raw_returns()), feed.dim_product)


@query
def dq005_dedup_order_lines(feed):
    return quality.latest_order_lines(feed.raw_sales())


@query
def dq006_gender_normalize(feed):
    return quality.normalize_gender(feed.raw_customer()).select("CUSTOMERKEY", "GENDER")


@query
def dq007_region_fill(feed):
    return quality.fill_regions(feed.raw_territory(), {10: "Region Ten", 11: "Region Eleven"})


# Masking and row access


def _by_role(feed, column: str, mask) -> DataFrame:
    return feed.dim_customer.select(
        "CUSTOMER_KEY",
        *[
            mask(F.col(column), role).alias(f"SEEN_BY_{tier.upper()}")
            for role, tier in ((ENGINEER, masks.PRIVILEGED), (ANALYST, masks.ANALYST), (VIEWER, masks.OTHER))
        ],
    )


@query
def mask_email(feed):
    return _by_role(feed, "EMAIL_ADDRESS", masks.mask_email)


@query
def mask_full_name(feed):
    return _by_role(feed, "FULL_NAME", masks.mask_full_name)


@query
def mask_income(feed):
    return _by_role(feed, "ANNUAL_INCOME", masks.mask_income)


@query
def mask_birth_date(feed):
    return _by_role(feed, "BIRTH_DATE", masks.mask_birth_date)


@query
def mask_phone(feed):
    phone = F.format_string("555-%03d-%04d", F.col("c_custkey") % 1000, F.col("c_custkey") * 7 % 10000)
    return feed.table("customer").select(
        F.col("c_custkey").alias("CUSTOMER_KEY"),
        masks.mask_phone(phone, "ADMIN_ROLE").alias("SEEN_BY_PRIVILEGED"),
        masks.mask_phone(phone, "ANALYST_ROLE").alias("SEEN_BY_ANALYST"),
        masks.mask_phone(phone, "PUBLIC").alias("SEEN_BY_OTHER"),
    )


@query
def masked_dim_customer(feed):
    return governance.masked_customers(feed.dim_customer, ANALYST)


@query
def masked_dim_customer_other(feed):
    return governance.masked_customers(feed.dim_customer, VIEWER)


@query
def masked_silver_customer(feed):
    return governance.masked_silver_customers(feed.customer(), VIEWER)


@query
def masked_income_grouping(feed):
    """Grouping sees the masked income."""
    seen = governance.masked_customers(feed.dim_customer, ANALYST)
    return seen.groupBy("ANNUAL_INCOME").agg(F.count(F.lit(1)).alias("CUSTOMERS"))


@query
def row_access_territory(feed):
    sales = feed.fact_sales("ORDER_NUMBER", "ORDER_LINE_ITEM", "TERRITORY_KEY", "GROSS_REVENUE")
    return governance.visible_sales(sales, governance.access_table(feed.spark), VIEWER, "VIEWER_USER")


@query
def row_access_by_role(feed):
    sales = feed.fact_sales("ORDER_NUMBER", "TERRITORY_KEY")
    access = governance.access_table(feed.spark)
    seen = [
        governance.visible_sales(sales, access, role, user).agg(
            F.lit(role).alias("ROLE_NAME"), F.lit(user).alias("USER_NAME"), F.count(F.lit(1)).alias("VISIBLE_ROWS")
        )
        for role, user in ((ENGINEER, "E"), (ANALYST, "A"), (VIEWER, "VIEWER_USER"), (VIEWER, "NOBODY"))
    ]
    return reduce(DataFrame.unionByName, seen)


@query
def pii_inventory(feed):
    return governance.pii_inventory(
        {
            "BRONZE_CUSTOMER": feed.raw_customer(),
            "SILVER_CUSTOMER": feed.customer(),
            "DIM_CUSTOMER": feed.dim_customer,
        }
    )


@query
def column_sensitivity(feed):
    return governance.sensitivity_report(feed.star())


# Layout and logs


def _clustered_fact(feed, keys, **options) -> DataFrame:
    path = scratch(feed, "clustered")
    layout.clustered_write(
        feed.fact_sales(), path, keys, lookup_columns=schemas.LOOKUP_COLUMNS["FACT_SALES"], **options
    )
    return feed.spark.read.parquet(path)


@query
def clustered_write(feed):
    return _clustered_fact(feed, schemas.CLUSTER_KEYS["FACT_SALES"], curved=True)


def content(df: DataFrame, name: str) -> DataFrame:
    """Rows of a table and a sum over hashes of its rows; decimals and load times, which engines print differently, are left out."""
    plain = sorted(f.name for f in df.schema if not f.dataType.typeName().startswith(("decimal", "double", "timestamp")))
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in plain]).cast("binary"))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return df.agg(
        F.lit(name).alias("TABLE_NAME"),
        F.count(F.lit(1)).alias("ROW_COUNT"),
        F.sum(number).alias("CONTENT"),
        F.lit(",".join(plain)).alias("COLUMNS"),
    )


@query
def clustered_tables(feed):
    """Rows and content of every table that is stored in an order, read back."""
    every = {
        "SILVER_SALES": silver.cleansed_sales(feed.sales_of_years()),
        "DIM_DATE": feed.dim_date,
        "DIM_CUSTOMER": feed.dim_customer,
        "DIM_PRODUCT": feed.dim_product,
        "FACT_SALES": feed.priced_sales(),
        "FACT_RETURNS": feed.fact_returns(),
    }
    root, large = scratch(feed, "clustered"), ("FACT_SALES", "SILVER_SALES", "FACT_RETURNS")
    completed = {"FACT_SALES": completed_sales, "SILVER_SALES": silver.completed_sales}
    stored = tables.refresh_tables(feed.spark, root, every, in_turn=large, completed=completed)
    return reduce(DataFrame.unionByName, [content(df, name) for name, df in stored.items()])


@query
def clustering_report(feed):
    """What does not depend on the names and the number of the files."""
    return clustering_facts(layout.clustering_report(_clustered_fact(feed, ["ORDER_DATE_KEY"]), "ORDER_DATE_KEY"))


def clustering_facts(files: DataFrame) -> DataFrame:
    """COUNTED: files, sorted by key, share at most a boundary key with the next, and every overlap count is that of the
    files that have a boundary in common."""
    before = F.lag("MAX_KEY").over(W.orderBy("MIN_KEY", "MAX_KEY"))
    bounds = files.select(F.explode(F.array_distinct(F.array("MIN_KEY", "MAX_KEY"))).alias("AT")).groupBy("AT")
    sharing = bounds.agg((F.count(F.lit(1)) - 1).alias("OTHERS"))
    first, last = (sharing.select(F.col("AT").alias(c), F.col("OTHERS").alias(f"{c}_OTHERS")) for c in ("MIN_KEY", "MAX_KEY"))
    at_end = F.when(F.col("MIN_KEY") < F.col("MAX_KEY"), F.col("MAX_KEY_OTHERS")).otherwise(0)
    right = (F.col("OVERLAPS") == F.col("MIN_KEY_OTHERS") + at_end) & (F.coalesce("BEFORE", "MIN_KEY") <= F.col("MIN_KEY"))
    met = files.withColumn("BEFORE", before).join(first, "MIN_KEY").join(last, "MAX_KEY")
    return met.withColumn("RIGHT", right).agg(
        F.sum("ROW_COUNT").alias("ROW_COUNT"),
        F.min("MIN_KEY").alias("MIN_KEY"),
        F.max("MAX_KEY").alias("MAX_KEY"),
        F.bool_and("RIGHT").alias("COUNTED"),
    )


@query
def point_lookup(feed):
    return layout.point_lookup(_stored(feed, "FACT_SALES", feed.fact_sales()), "ORDER_NUMBER", 42)


@query
def point_lookup_customer(feed):
    found = _stored(feed, "DIM_CUSTOMER", feed.dim_customer)
    return layout.point_lookup(found, "EMAIL_ADDRESS", "customer000000007@example.com")


@query
def point_lookup_customer_name(feed):
    return layout.point_lookup(_stored(feed, "DIM_CUSTOMER", feed.dim_customer), "FULL_NAME", "Customer 000000007")


@query
def point_lookup_product(feed):
    return layout.point_lookup(_stored(feed, "DIM_PRODUCT", feed.dim_product), "PRODUCT_SKU", "SKU-11")


@query
def point_lookup_product_name(feed):
    product = feed.dim_product
    name = product.agg(F.min("PRODUCT_NAME")).first()[0]
    return layout.point_lookup(_stored(feed, "DIM_PRODUCT", product), "PRODUCT_NAME", name)


@query
def top_expensive_queries(feed):
    return layout.top_expensive_queries(feed.query_log())


@query
def usage_by_group(feed):
    return layout.usage_by_group(feed.query_log(), F.lit(datetime(2024, 2, 15)).cast("timestamp_ntz"))
