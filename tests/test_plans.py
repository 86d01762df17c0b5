from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orefold.operators import gold, silver
from orefold.plans import business, reports, views

FACT = (
    "ORDER_NUMBER string, ORDER_LINE_ITEM long, ORDER_DATE_KEY date, PRODUCT_KEY long, CUSTOMER_KEY long, "
    "TERRITORY_KEY long, ORDER_QUANTITY long, GROSS_REVENUE decimal(14,2), TOTAL_COST decimal(14,2), "
    "GROSS_PROFIT decimal(14,2), MARGIN_PCT decimal(7,2)"
)
RETURNS = "RETURN_DATE_KEY date, PRODUCT_KEY long, TERRITORY_KEY long, RETURN_QUANTITY long, RETURN_REVENUE_IMPACT decimal(14,2)"


def line(order, day, product=1, customer=1, quantity=1, revenue="10", number=1):
    amount = Decimal(revenue)
    return (order, number, day, product, customer, 1, quantity, amount, amount / 2, amount / 2, Decimal("50"))


@pytest.fixture
def fact(spark):
    return lambda *lines: spark.createDataFrame(list(lines), FACT)


@pytest.fixture
def returned(spark):
    return lambda *rows: spark.createDataFrame(
        [(date(2020, 2, 1), product, 1, quantity, Decimal(quantity)) for product, quantity in rows], RETURNS
    )


@pytest.fixture(scope="module")
def dim_date(spark):
    days = spark.sql("SELECT cast(d AS string) AS DATE FROM (SELECT explode(sequence(date'2019-01-01', date'2022-12-31')) AS d)")
    return gold.dim_date(silver.calendar(days)).cache()


@pytest.fixture(scope="module")
def dim_product(spark):
    names = spark.createDataFrame(
        [(1, "bolt", "A"), (2, "bolt", "A"), (3, "nut", "B"), (4, "cap", "C")],
        "PRODUCT_KEY long, PRODUCT_NAME string, CATEGORY_NAME string",
    )
    return names.withColumns(
        {
            "PRODUCT_SKU": F.lit("s"),
            "SUBCATEGORY_NAME": F.lit("u"),
            "PRICE_TIER": F.lit("Budget"),
            "PRODUCT_PRICE": F.lit(Decimal("10")),
            "MARGIN_PCT": F.lit(Decimal("50")),
        }
    )


def brute_force_pairs(fact, returned):
    """The published join, row by row."""
    return (
        fact.join(returned.withColumnRenamed("PRODUCT_KEY", "BACK"), F.col("PRODUCT_KEY") == F.col("BACK"), "left")
        .groupBy("PRODUCT_KEY")
        .agg(F.sum("ORDER_QUANTITY"), F.coalesce(F.sum("RETURN_QUANTITY"), F.lit(0)), F.sum("GROSS_REVENUE"))
    )


def test_return_rate_literal_and_safe(fact, returned, dim_product):
    day = date(2020, 1, 5)
    sales, back = fact(line("a", day, quantity=1), line("b", day, quantity=3)), returned((1, 1), (4, 9))
    literal = business.return_rate(sales, dim_product, back).collect()
    assert [(r.UNITS_SOLD, r.UNITS_RETURNED, r.RETURN_RATE_PCT) for r in literal] == [(4, 2, 50)]
    safe = business.return_rate_safe(sales, dim_product, back).collect()
    assert [(r.UNITS_SOLD, r.UNITS_RETURNED, r.RETURN_RATE_PCT) for r in safe] == [(4, 1, 25)]
    by_category = {r.CATEGORY_NAME: r for r in reports.returns_sql(sales, back, dim_product).collect()}
    assert (by_category["A"].UNITS_RETURNED, by_category["A"].UNITS_SOLD) == (2, 4)
    assert (by_category["C"].UNITS_RETURNED, by_category["C"].UNITS_SOLD, by_category["C"].RETURN_RATE_PCT) == (9, 0, None)


def test_pair_totals_equal_the_row_by_row_join(fact, returned, dim_product):
    day = date(2020, 1, 5)
    sales = fact(*[line(f"o{i}", day, product=1 + i % 3, quantity=i, revenue=str(i)) for i in range(30)])
    back = returned(*[(1 if i % 2 else 2, i) for i in range(17)])
    expected = {r[0]: tuple(r)[1:] for r in brute_force_pairs(sales, back).collect()}
    view = views.product_performance(sales, dim_product, back).collect()
    assert {r.PRODUCT_KEY: (r.UNITS_SOLD, r.UNITS_RETURNED, r.TOTAL_REVENUE) for r in view} == expected
    safe = views.product_performance_safe(sales, dim_product, back)
    assert safe.agg(F.sum("UNITS_SOLD")).first()[0] == sum(range(30))


def test_fiscal_labels_of_the_quarter_question(fact, dim_date):
    sales = fact(line("a", date(2020, 7, 1)), line("b", date(2020, 1, 15)))
    found = business.fiscal_quarter(sales, dim_date).select("FISCAL_QUARTER", "FISCAL_YEAR").collect()
    assert [tuple(r) for r in found] == [("2020-Q3", 2019), ("2020-Q1", 2020)]


def test_month_over_month_and_year_to_date(fact, dim_date):
    sales = fact(
        line("a", date(2020, 1, 5), revenue="100"),
        line("b", date(2020, 3, 5), revenue="150"),
        line("c", date(2021, 1, 5), revenue="0"),
        line("d", date(2021, 2, 5), revenue="7"),
    )
    trend = [(r.PREV_MONTH_REVENUE, r.MOM_GROWTH_PCT) for r in business.monthly_trend(sales, dim_date).collect()]
    assert trend == [(None, None), (100, 50), (150, -100), (0, None)]
    ytd = [r.YTD_REVENUE for r in business.running_ytd(sales, dim_date).collect()]
    assert ytd == [100, 250, 0, 7]
    yoy = [(r.YEAR, r.PREV_YEAR_REVENUE, r.YOY_GROWTH_PCT) for r in business.quarterly_yoy(sales, dim_date).collect()]
    assert yoy == [(2020, None, None), (2021, 250, Decimal("-97.20"))]


def test_orders_are_counted_once_and_averages_are_stated(fact, dim_date):
    sales = fact(
        line("a", date(2020, 1, 4), revenue="10"),
        line("a", date(2020, 1, 4), revenue="20", number=2),
        line("b", date(2020, 1, 6), revenue="40"),
        line("x", None, revenue="1000"),
    )
    year = business.sales_by_year(sales, dim_date).collect()
    assert [(r.TOTAL_ORDERS, r.TOTAL_REVENUE, r.AVG_ORDER_VALUE) for r in year] == [(2, 70, 35)]
    split = {r.DAY_TYPE: (r.TOTAL_ORDERS, r.AVG_ORDER_REVENUE) for r in business.weekend_weekday(sales, dim_date).collect()}
    assert split == {"Weekend": (1, 15), "Weekday": (1, 40)}
    months = views.monthly_kpi(sales, dim_date).collect()
    assert [(r.YEAR_MONTH, r.TOTAL_LINE_ITEMS) for r in months] == [("2020-01", 3)]


def test_age_bands_and_segments(spark, fact):
    born = [(1, date(1973, 12, 31)), (2, date(1972, 1, 1)), (3, date(1962, 6, 1)), (4, None)]
    customers = spark.createDataFrame(born, "CUSTOMER_KEY long, BIRTH_DATE date").withColumns(
        {c: F.lit("x") for c in ("INCOME_BAND", "OCCUPATION", "GENDER", "MARITAL_STATUS")}
    )
    day = date(2001, 5, 1)
    lines = [line(f"o{c}", day, customer=c) for c in (1, 2, 3, 4)] + [line("o1", day, customer=1, revenue="20", number=2)]
    found = business.age_bands(fact(*lines), customers, date(2002, 1, 1)).collect()
    assert [(r.AGE_BAND, r.CUSTOMERS, r.TOTAL_ORDERS, r.AVG_ORDER_VALUE) for r in found] == [
        ("18-29", 1, 1, 15), ("30-39", 1, 1, 10), ("40-49", 1, 1, 10)
    ]
    segment = business.customer_segments(fact(*lines), customers).first()
    assert (segment.CUSTOMER_COUNT, segment.TOTAL_ORDERS, segment.TOTAL_REVENUE, segment.REVENUE_PER_CUSTOMER) == (4, 4, 60, 15)


def test_customer_360_recency_counts_from_the_last_order_of_all(spark, fact):
    customers = spark.createDataFrame([(1,), (2,), (3,)], "CUSTOMER_KEY long").withColumns(
        {c: F.lit("x") for c in ("FULL_NAME", "GENDER", "AGE", "INCOME_BAND", "OCCUPATION", "EDUCATION_LEVEL", "MARITAL_STATUS", "IS_HOME_OWNER")}
    )
    sales = fact(line("a", date(2020, 1, 1)), line("b", date(2020, 12, 31), customer=2), line("c", date(2021, 1, 1), customer=9))
    found = {r.CUSTOMER_KEY: (r.RECENCY_DAYS, r.RFM_SEGMENT) for r in views.customer_360(sales, customers).collect()}
    assert found == {1: (366, "Lost"), 2: (1, "At Risk")}


REPORT_LINE = (
    "ORDERNUMBER string, YEAR int, MONTH int, ORDERQUANTITY long, REVENUE decimal(20,4), PROFIT decimal(20,4), "
    "MARGIN decimal(28,10), CATEGORYNAME string, PRODUCTKEY long, CUSTOMERKEY long, COUNTRY string, REGION string, "
    "OCCUPATION string, GENDER string"
)


def test_reports_drop_null_groups_and_sum_orders_over_years(spark):
    data = [
        ("a", 2020, 1, 1, Decimal("10.005"), Decimal(5), Decimal(50), "A", 1, 1, "X", "r", "o", "M"),
        ("a", 2021, None, 1, Decimal(20), Decimal(5), Decimal(25), None, 2, 1, "X", None, "o", None),
        ("b", 2021, 2, 1, Decimal(0), Decimal(0), None, "B", 3, 2, "Y", "s", None, "F"),
    ]
    lines = spark.createDataFrame(data, REPORT_LINE)
    by_year = reports.sales_by_year(lines)
    assert [(r.YEAR, r.ORDERS, r.REVENUE, r.MARGIN_PCT) for r in by_year.collect()] == [
        (2020, 1, Decimal("10.01"), Decimal("49.98")), (2021, 2, 20, 25)
    ]
    assert [r.MONTH_NAME for r in reports.monthly_trend(lines).collect()] == ["Jan", "Feb"]
    categories = reports.category_revenue(lines)
    assert [(r.CATEGORY_NAME, r.MARGIN_PCT) for r in categories.collect()] == [("A", 50), ("B", None)]
    kpi = reports.kpis(by_year, categories, reports.territory(lines)).first()
    assert (kpi.TOTAL_ORDERS, kpi.TOP_CATEGORY, kpi.TOP_COUNTRY, kpi.YEARS) == (3, "A", "X", "2020,2021")
    assert [(r.OCCUPATION, r.GENDER) for r in reports.customer_segment(lines).collect()] == [("o", "M")]
    back = spark.createDataFrame([(1, 3), (1, 1), (99, 5)], "PRODUCTKEY long, RETURNQUANTITY long")
    assert [(r.CATEGORY_NAME, r.UNITS_SOLD, r.UNITS_RETURNED) for r in reports.returns(lines, back).collect()] == [("A", 1, 4), ("B", 1, 0)]


def test_kpis_of_nothing(spark):
    lines = spark.createDataFrame([], REPORT_LINE)
    kpi = reports.kpis(reports.sales_by_year(lines), reports.category_revenue(lines), reports.territory(lines)).first()
    assert (kpi.TOP_CATEGORY, kpi.TOP_COUNTRY, kpi.YEARS) == ("N/A", "N/A", "")


def test_shares_add_up(spark, fact, dim_product):
    day = date(2020, 1, 5)
    sales = fact(*[line(f"o{i}", day, product=1 + i % 4, revenue=str(i + 1)) for i in range(12)])
    tiers = dim_product.withColumn("PRODUCT_PRICE", F.col("PRODUCT_KEY") * 150)
    assert sum(r.REVENUE_PCT for r in business.price_tier_mix(sales, tiers).collect()) == pytest.approx(100, abs=Decimal("0.02"))
