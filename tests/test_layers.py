from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from orefold import schemas, session
from orefold.operators import gold, silver
from orefold.sources.starfeed import StarFeed


def frame(spark, table, *data):
    return spark.createDataFrame(list(data), schemas.nullable(schemas.TABLES[table]))


def sales_row(order, line=1, ordered="2020-01-04", product=1, quantity=1, stocked="2020-01-01"):
    return (ordered, stocked, order, product, 7, 1, line, quantity)


def raw_sales(spark, *data):
    return frame(spark, "BRONZE_SALES_2020", *data).withColumn("SOURCE_FILE", F.lit("f"))


def test_calendar_row(spark):
    raw = frame(spark, "BRONZE_CALENDAR", ("2020-01-04",), ("bad",), ("1/4/2020",), (None,))
    found = gold.dim_date(silver.calendar(raw)).collect()
    assert len(found) == 1
    day = found[0].asDict()
    assert day == {
        "DATE_KEY": date(2020, 1, 4),
        "YEAR": 2020,
        "MONTH_NUM": 1,
        "MONTH_NAME": "Jan",
        "DAY_OF_MONTH": 4,
        "DAY_OF_WEEK_NAME": "Sat",
        "DAY_OF_WEEK_NUM": 6,
        "QUARTER_NUM": 1,
        "QUARTER_NAME": "Q1",
        "WEEK_OF_YEAR": 1,
        "IS_WEEKEND": True,
        "FIRST_DAY_OF_MONTH": date(2020, 1, 1),
        "LAST_DAY_OF_MONTH": date(2020, 1, 31),
        "FISCAL_YEAR": 2020,
        "FISCAL_MONTH": 7,
        "FISCAL_QUARTER": "FQ3",
    }


def test_calendar_of_the_source_range_has_912_days(spark):
    days = spark.sql("SELECT cast(d AS string) AS DATE FROM (SELECT explode(sequence(date'2020-01-01', date'2022-06-30')) AS d)")
    assert silver.calendar(days).count() == 912


def test_layer_schemas_are_the_declared_ones(spark):
    categories = frame(spark, "BRONZE_PRODUCT_CATEGORY", (1, "Bikes"))
    subcategories = frame(spark, "BRONZE_SUBCATEGORY", (1, "Road", 1))
    raw_product = frame(spark, "BRONZE_PRODUCT", (1, 1, "s", "n", "m", "d", "c", "z", "y", Decimal(60), Decimal(100)))
    product = silver.product(raw_product, subcategories, categories)
    customer = silver.customer(frame(spark, "BRONZE_CUSTOMER", (1, *[None] * 12)))
    calendar = silver.calendar(frame(spark, "BRONZE_CALENDAR", ("2020-01-04",)))
    territory = silver.territory(frame(spark, "BRONZE_TERRITORY", (1, "a", "b", "c")))
    sales = silver.sales([(2020, raw_sales(spark, sales_row("a")))])
    returns = silver.returns(frame(spark, "BRONZE_RETURNS", ("2020-01-04", 1, 1, 1)))
    wide = frame(spark, "BRONZE_CATEGORY_SALES_UNPIVOT", ("7/1/2022", "Bikes", 1, 2, 3))
    dim_product = gold.dim_product(product)
    built = {
        "SILVER_CALENDAR": calendar,
        "SILVER_TERRITORY": territory,
        "SILVER_PRODUCT_CATEGORY": silver.product_category(categories, subcategories),
        "SILVER_PRODUCT": product,
        "SILVER_CUSTOMER": customer,
        "SILVER_SALES": sales,
        "SILVER_RETURNS": returns,
        "SILVER_CATEGORY_SALES_UNPIVOT": silver.unpivot_category_sales(wide),
        "DIM_DATE": gold.dim_date(calendar),
        "DIM_CUSTOMER": gold.dim_customer(customer),
        "DIM_PRODUCT": dim_product,
        "DIM_TERRITORY": gold.dim_territory(territory),
        "FACT_SALES": gold.fact_sales(sales, dim_product),
        "FACT_RETURNS": gold.fact_returns(returns, dim_product),
    }
    assert set(built) == set(schemas.SILVER) | set(schemas.GOLD)
    for name, df in built.items():
        declared = [(f.name, f.dataType.simpleString()) for f in schemas.TABLES[name].fields]
        assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == declared, name


def test_product_sentinels_and_margins(spark):
    categories = frame(spark, "BRONZE_PRODUCT_CATEGORY", (1, "Bikes"), (2, " Empty "))
    subcategories = frame(spark, "BRONZE_SUBCATEGORY", (10, "Road", 1), (11, "Odd", 9))

    def row(key, sub, color, size, style, cost, price):
        return (key, sub, " sku ", "n", "m", "d", color, size, style, Decimal(cost), Decimal(price))

    raw = frame(
        spark,
        "BRONZE_PRODUCT",
        row(1, 10, "0", "0", None, "60", "100"),
        row(2, 11, " Red ", "M", "U", "5", "0"),
        row(3, 99, None, None, "0", "12", "10"),
        row(None, 10, "x", "x", "x", "1", "1"),
    )
    found = {r.PRODUCT_KEY: r for r in silver.product(raw, subcategories, categories).collect()}
    assert set(found) == {1, 2, 3}
    assert (found[1].PRODUCT_COLOR, found[1].PRODUCT_SIZE, found[1].PRODUCT_STYLE) == ("Unknown", "N/A", "N/A")
    assert found[2].PRODUCT_COLOR == "Red"
    assert [found[k].MARGIN_PCT for k in (1, 2, 3)] == [Decimal("40.00"), None, Decimal("-20.00")]
    assert (found[1].CATEGORY_NAME, found[1].CATEGORY_KEY) == ("Bikes", 1)
    assert (found[2].SUBCATEGORY_NAME, found[2].CATEGORY_NAME) == ("Odd", None)
    assert found[3].SUBCATEGORY_NAME is None
    listed = silver.product_category(categories, subcategories).collect()
    assert {(r.CATEGORY_NAME, r.SUBCATEGORY_NAME) for r in listed} == {("Bikes", "Road"), ("Empty", None)}


def test_customer_defaults(spark):
    raw = frame(
        spark,
        "BRONZE_CUSTOMER",
        (1, "MR.", " JON ", "YANG", "1966-04-08", "M", "M", " Jon24@EXAMPLE.com ", 90000, 2, "Bachelors", "Professional", "Y"),
        (2, None, "a", None, "4/8/1966", "X", "Male", None, None, None, None, None, "N"),
        (None, *[None] * 12),
    )
    found = {r.CUSTOMER_KEY: r for r in silver.customer(raw, date(2002, 1, 1)).collect()}
    assert set(found) == {1, 2}
    jon, other = found[1], found[2]
    assert (jon.FULL_NAME, jon.EMAIL_ADDRESS, jon.AGE, jon.INCOME_BAND) == ("Jon Yang", "jon24@example.com", 36, "High")
    assert (jon.MARITAL_STATUS, jon.GENDER, jon.IS_HOME_OWNER) == ("Married", "Male", True)
    assert (other.FULL_NAME, other.BIRTH_DATE, other.AGE) == (None, None, None)
    assert (other.ANNUAL_INCOME, other.INCOME_BAND, other.TOTAL_CHILDREN) == (0, "Very High", 0)
    assert (other.EDUCATION_LEVEL, other.OCCUPATION, other.GENDER, other.IS_HOME_OWNER) == ("Unknown", "Unknown", "Unknown", False)


def test_sales_keep_repeated_lines_and_type_dates(spark):
    first = raw_sales(spark, sales_row("a"), sales_row(None), sales_row("b", ordered="1/4/2020", quantity=None))
    second = raw_sales(spark, sales_row("a", ordered="2019-12-30"))
    found = silver.sales([(2020, first), (2021, second)]).collect()
    assert sorted((r.ORDER_NUMBER, r.SALES_YEAR) for r in found) == [("a", 2020), ("a", 2021), ("b", 2020)]
    by_key = {(r.ORDER_NUMBER, r.SALES_YEAR): r for r in found}
    assert by_key["a", 2020].DAYS_FROM_STOCK_TO_ORDER == 3
    assert by_key["a", 2021].DAYS_FROM_STOCK_TO_ORDER == -2
    assert by_key["b", 2020].ORDER_DATE is None and by_key["b", 2020].DAYS_FROM_STOCK_TO_ORDER is None
    assert by_key["b", 2020].ORDER_QUANTITY == 0


def test_returns_keep_a_date_that_does_not_parse(spark):
    raw = frame(spark, "BRONZE_RETURNS", ("2020-01-04", 1, 1, None), ("bad", 1, 1, 2), (None, 1, 1, 3))
    assert sorted((r.RETURN_QUANTITY, r.RETURN_DATE) for r in silver.returns(raw).collect()) == [(0, date(2020, 1, 4)), (2, None)]


def test_unpivot_of_20_rows_and_back(spark):
    data = [(f"7/{d}/2022", f"c{d % 4}", d, None if d == 3 else 2 * d, 3 * d) for d in range(1, 21)]
    wide = frame(spark, "BRONZE_CATEGORY_SALES_UNPIVOT", *data)
    long = silver.unpivot_category_sales(wide)
    assert long.count() == 60
    assert long.filter("SALES_AMOUNT = 0").select("REGION", "SALE_DATE").collect() == [("Central", date(2022, 7, 3))]
    from orefold.plans import business

    back = {r.SALE_DATE.day: (r.NORTH, r.CENTRAL, r.SOUTH, r.TOTAL) for r in business.pivot_regions(long).collect()}
    assert back[3] == (3, 0, 9, 12) and back[20] == (20, 40, 60, 120) and len(back) == 20


def test_facts_price_an_unknown_product_at_zero(spark):
    dim = spark.createDataFrame(
        [(1, Decimal("10.005"), Decimal("4"), Decimal("60.02"))],
        "PRODUCT_KEY long, PRODUCT_PRICE decimal(12,4), PRODUCT_COST decimal(12,4), MARGIN_PCT decimal(7,2)",
    )
    raw = raw_sales(spark, sales_row("a", quantity=3), sales_row("b", product=5, quantity=2), sales_row("c", product=None))
    found = {r.ORDER_NUMBER: r for r in gold.fact_sales(silver.sales([(2020, raw)]), dim).collect()}
    a, b = found["a"], found["b"]
    assert (a.GROSS_REVENUE, a.TOTAL_COST, a.GROSS_PROFIT) == (Decimal("30.02"), Decimal("12.00"), Decimal("18.02"))
    assert (b.UNIT_PRICE, b.GROSS_REVENUE, b.MARGIN_PCT) == (0, 0, 0)
    assert found["c"].GROSS_REVENUE == 0
    returned = silver.returns(frame(spark, "BRONZE_RETURNS", ("2020-01-04", 1, 1, 2), ("2020-01-04", 1, 5, 2)))
    impacts = {r.PRODUCT_KEY: r.RETURN_REVENUE_IMPACT for r in gold.fact_returns(returned, dim).collect()}
    assert impacts == {1: Decimal("20.01"), 5: Decimal("0.00")}


def test_partitions_of_a_shuffle_grow_with_the_input_and_stay_small(spark):
    first, merged = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(merged)
    try:
        spark.conf.set(merged, "64MB")
        assert session.fit_shuffles(spark, 100) == int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert spark.conf.get(merged) == str(session.MERGED_UP_TO)
        found = [session.fit_shuffles(spark, n << 30) for n in (1, 6)]
        assert found[1] == 6 * found[0] and spark.conf.get(first) == str(found[1])
        spark.conf.set(merged, "1MB")
        session.fit_shuffles(spark, 100)
        assert spark.conf.get(merged) == "1MB"
    finally:
        spark.conf.set(merged, before)
        spark.conf.unset(first)


def test_a_query_sets_the_partitions_of_its_tables(spark, tmp_path):
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    path = str(tmp_path / "t")
    (tmp_path / "t" / "lineitem.parquet").mkdir(parents=True)
    with open(tmp_path / "t" / "lineitem.parquet" / "part-0.parquet", "wb") as f:
        f.truncate(20 * session.INPUT_PER_PARTITION)
    feed = StarFeed(spark, path)
    assert feed.stored_bytes == 20 * session.INPUT_PER_PARTITION
    try:
        assert session.fit_shuffles(spark, feed.stored_bytes) == 20
    finally:
        spark.conf.unset(first)
