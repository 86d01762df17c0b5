from datetime import date, datetime
from decimal import Decimal
from statistics import median

import pytest

from orefold import schemas
from orefold.functions import masks
from orefold.operators import governance, profiling, quality


def test_null_profile_and_numeric_hint(spark):
    df = spark.createDataFrame([("1", " ", "1_0", None), ("x", None, "-.5e3", None), ("nan", "a", "1f", None)], "a string, b string, c string, d string")
    profile = {r.COLUMN_NAME: (r.TOTAL_ROWS, r.NULL_COUNT, r.NULL_PCT) for r in profiling.null_profile(df).collect()}
    assert profile == {"a": (3, 0, 0), "b": (3, 2, Decimal("66.67")), "c": (3, 0, 0), "d": (3, 3, 100)}
    hint = {r.COLUMN_NAME: r.IS_NUMERIC for r in profiling.numeric_hint(df).collect()}
    assert hint == {"a": False, "b": False, "c": False, "d": True}
    numbers = spark.createDataFrame([(v,) for v in ("1", "+2.", "1e5", "Infinity", "-inf", "1_000", " 3 ")], "v string")
    assert profiling.numeric_hint(numbers).first().IS_NUMERIC
    for text in ("1__0", "_1", "1e", "0x1", ".", "1d"):
        assert not profiling.numeric_hint(spark.createDataFrame([(text,)], "v string")).first().IS_NUMERIC, text
    assert [r.NULL_PCT for r in profiling.null_profile(df.limit(0)).collect()] == [0] * 4


def test_duplicates_and_reconciliation(spark):
    customers = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "CUSTOMERKEY long")
    odd = spark.createDataFrame([(1,)], "v long")
    found = profiling.duplicate_groups({"BRONZE_CUSTOMER": customers, "ODD": odd}, schemas.UNIQUE_KEYS)
    assert dict(found.collect()) == {"BRONZE_CUSTOMER": 2, "ODD": None}
    both = profiling.reconcile({"a": customers, "b": odd}, {"a": odd, "c": odd}).collect()
    assert {r.TABLE_NAME: (r.SOURCE_ROWS, r.LOADED_ROWS, r.DIFFERENCE) for r in both} == {"a": (5, 1, -4), "b": (1, None, None), "c": (None, 1, None)}


def test_orphans_count_null_keys_and_the_report_warns(spark):
    fact = spark.createDataFrame(
        [(1, 1, 1, date(2020, 1, 1), Decimal(5)), (9, None, 1, None, Decimal(-1)), (9, 1, 1, date(2020, 1, 1), Decimal(0))],
        "PRODUCT_KEY long, CUSTOMER_KEY long, TERRITORY_KEY long, ORDER_DATE_KEY date, GROSS_REVENUE decimal(14,2)",
    )
    dims = {key: spark.createDataFrame([(1,)], f"{key} long") for key in quality.ORPHAN_CHECKS}
    report = quality.report(fact, dims).collect()
    assert {r.CHECK_NAME: (r.FAILED_ROWS, r.STATUS) for r in report} == {
        "Orphaned PRODUCT_KEY in FACT_SALES": (2, "WARN"),
        "Orphaned CUSTOMER_KEY in FACT_SALES": (1, "WARN"),
        "Orphaned TERRITORY_KEY in FACT_SALES": (0, "PASS"),
        "Negative GROSS_REVENUE in FACT_SALES": (1, "WARN"),
        "NULL ORDER_DATE_KEY in FACT_SALES": (1, "WARN"),
    }
    assert not any(r.ALL_PASSED for r in report)
    clean = fact.filter("PRODUCT_KEY = 1")
    assert all(r.ALL_PASSED for r in quality.report(clean, dims).collect())


@pytest.mark.parametrize(
    "values",
    [[5], [1, 2], [3, 1, 2], [-5000, -1, 0, 7, 123456, 123457], [10] * 50 + [999_999] * 49, [1] * 3 + [2000] * 3, list(range(0, 30_000, 7))],
)
def test_exact_median(spark, values):
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v long")
    assert quality.exact_median(df, "v") == median(values)


@pytest.mark.parametrize(
    "values",
    [[10**15, *range(30_000, 90_000, 7)], [-(2**63), 2**63 - 1, 5], [-(2**63), *range(1000), 2**63 - 1], [2**63 - 1] * 4],
)
def test_exact_median_with_far_outliers(spark, values):
    assert quality.exact_median(spark.createDataFrame([(v,) for v in values], "v long"), "v") == median(values)


def test_exact_median_narrows_until_no_part_is_large(spark, monkeypatch):
    """One income of 1e15 leaves no pass with more parts than allowed, and several passes."""
    passes, at = [], quality._value_at
    monkeypatch.setattr(quality, "_value_at", lambda *a: passes.append(a) or at(*a))
    monkeypatch.setattr(quality, "_BUCKETS", 100)
    values = [10**15, *range(30_000, 90_000, 7)]
    assert quality.exact_median(spark.createDataFrame([(v,) for v in values], "v long"), "v") == median(values)
    assert quality.exact_median(spark.createDataFrame([], "v long"), "v") is None and len(passes) == 1


def test_income_imputation(spark):
    df = spark.createDataFrame([(30_000,), (50_000,), (130_000,), (None,)], "ANNUALINCOME long")
    assert sorted(tuple(r) for r in quality.impute_income(df).collect()) == [
        (30_000, "Low"), (50_000, "Medium"), (50_000, "Unknown"), (130_000, "Very High")
    ]


def test_margin_flag_unknown_product_and_regions(spark):
    products = spark.createDataFrame(
        [(1, "A", Decimal(6), Decimal(10), Decimal(40)), (2, "A", Decimal(12), Decimal(10), Decimal(-20))],
        "PRODUCT_KEY long, CATEGORY_NAME string, PRODUCT_COST decimal(12,4), PRODUCT_PRICE decimal(12,4), MARGIN_PCT decimal(7,2)",
    )
    flagged = quality.flag_margin(products)
    assert {r.PRODUCT_KEY: r.MARGIN_FLAG for r in flagged.collect()} == {1: None, 2: "NEGATIVE"}
    margins = quality.category_margins(flagged).first()
    assert (margins.AVG_MARGIN_PCT, margins.AVG_MARGIN_PCT_ALL, margins.NEGATIVE_PRODUCTS) == (40, 10, 1)
    names = spark.createDataFrame([(1, "bolt")], "PRODUCT_KEY long, PRODUCT_NAME string")
    returns = spark.createDataFrame([(1,), (9,), (None,)], "PRODUCT_KEY long")
    named = quality.name_unknown_products(returns, names).collect()
    assert {r.PRODUCT_KEY: r.PRODUCT_NAME for r in named} == {1: "bolt", 9: "UNKNOWN", None: "UNKNOWN"}
    territories = spark.createDataFrame([(10, " "), (11, None), (1, "North"), (12, None)], "SALESTERRITORYKEY long, REGION string")
    filled = quality.fill_regions(territories, {10: "Ten", 11: "Eleven", 1: "never"}).collect()
    assert dict(filled) == {10: "Ten", 11: "Eleven", 1: "North", 12: None}


def test_latest_order_line_wins(spark):
    early, late = datetime(2020, 1, 1), datetime(2020, 1, 2)
    data = [("a", 1, early, 5), ("a", 1, late, 3), ("a", 2, early, 1), ("b", 1, late, 2), ("b", 1, late, 9), (None, 1, early, 1), (None, 1, late, 2)]
    df = spark.createDataFrame(data, "ORDERNUMBER string, ORDERLINEITEM long, LOAD_TIMESTAMP timestamp_ntz, ORDERQUANTITY long")
    found = {(r.ORDERNUMBER, r.ORDERLINEITEM): r.ORDERQUANTITY for r in quality.latest_order_lines(df).collect()}
    assert found == {("a", 1): 3, ("a", 2): 1, ("b", 1): 9, (None, 1): 2}


def test_required_columns(spark):
    dim = spark.createDataFrame([(1, "x"), (None, "y")], "TERRITORY_KEY long, REGION string")
    assert [tuple(r) for r in quality.required_columns({"DIM_TERRITORY": dim}).collect()] == [("DIM_TERRITORY", "TERRITORY_KEY", "bigint", "bigint", True, 1)]


def test_row_access(spark):
    fact = spark.createDataFrame([(1, 10), (9, 20)], "TERRITORY_KEY long, V long")
    access = governance.access_table(spark)

    def seen(role, user):
        return sorted(r.TERRITORY_KEY for r in governance.visible_sales(fact, access, role, user).collect())

    assert seen("VIEWER_ROLE", "VIEWER_USER") == [1]
    assert seen("ADMIN_ROLE", "x") == seen("ANALYST_ROLE", "x") == [1, 9]
    assert seen("VIEWER_ROLE", "stranger") == []
    tiers = {"steward": masks.PRIVILEGED}
    assert governance.visible_sales(fact, access, "STEWARD", "x", tiers).count() == 2
    assert governance.visible_sales(fact, access, "ADMIN_ROLE", "x", tiers).count() == 0


def test_masked_table_shows_no_raw_value(spark):
    dim = spark.createDataFrame(
        [(1, "Jon", "Jon Yang", "jon@example.com", 84_999, date(1966, 4, 8))],
        "CUSTOMER_KEY long, FIRST_NAME string, FULL_NAME string, EMAIL_ADDRESS string, ANNUAL_INCOME long, BIRTH_DATE date",
    )
    row = governance.masked_customers(dim, "VIEWER_ROLE").first()
    assert tuple(row) == (1, "Jon", "J.Y.", "***@***.com", 0, None)
    assert governance.masked_silver_customers(dim, "VIEWER_ROLE").first().ANNUAL_INCOME == 84_999
    tiers = {"STEWARD": masks.PRIVILEGED, "ADMIN_ROLE": masks.OTHER}
    assert tuple(governance.masked_customers(dim, "steward", tiers).first()) == tuple(dim.first())
    assert governance.masked_customers(dim, "ADMIN_ROLE", tiers).first().EMAIL_ADDRESS == "***@***.com"


def test_required_and_layout_declarations_name_known_columns():
    for declared in (schemas.CLUSTER_KEYS, schemas.LOOKUP_COLUMNS, schemas.UNIQUE_KEYS):
        for table, columns in declared.items():
            assert set(columns) <= set(schemas.TABLES[table].names)
    for table, column, _, _ in schemas.PII_COLUMNS:
        assert column in schemas.TABLES[table].names
    assert set(schemas.SOURCE_FILES.values()) == set(schemas.BRONZE)
