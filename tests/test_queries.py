"""Every registered query against its SQL on the smallest tables, and the shape of the plans."""

import re

import pytest
from pyspark.sql import functions as F

from checks import compare
from checks.oracles import ORACLES
from checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

# Building these writes files; their plans only read them back.
WRITING = {
    "csv_scan", "csv_format_options", "csv_encoding", "audit_columns", "full_refresh_load", "copy_into_tolerant",
    "copy_into_tolerant_rejects", "load_registry", "row_count_report", "ctas_refresh", "mv_monthly_revenue",
    "report_sink", "mapping_table_insert", "point_in_time_read", "retention_filter", "clustered_write",
    "clustering_report", "view_registry", "clustered_tables", "files_to_sales_by_year", "point_lookup",
    "point_lookup_customer", "point_lookup_customer_name", "point_lookup_product", "point_lookup_product_name",
}


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    assert compare.difference(spark, con, FOLDER, name) is None


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_cross_join_and_no_python(spark):
    """Without broadcasts, as for large dimensions, every join must still be an equi join inside the engine."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in set(QUERIES) - WRITING:
            text = plan(QUERIES[name](spark, FOLDER))
            for operator in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
                assert operator not in text, f"{operator} in {name}"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_scans_read_only_what_is_needed(spark):
    text = plan(QUERIES["q04_top10_products"](spark, FOLDER))
    assert "orders.parquet" not in text and "l_tax" not in text
    assert "EqualTo(l_returnflag,R)" in plan(QUERIES["silver_returns"](spark, FOLDER))


def test_counting_orders_reuses_the_partitioning_of_the_order_join(spark):
    """One shuffle of the lines: the join with orders, whose result is already grouped by order."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        text = plan(QUERIES["q01_sales_by_year"](spark, "/root/testdata/sf0.01"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(YEAR" in text
    assert not any("hashpartitioning(YEAR" in line and "ORDER_NUMBER" in line for line in text.splitlines())


def scans(df, table: str) -> int:
    """Scans of a table in the plan, before adaptive execution reuses any."""
    return plan(df).count(f"/{table}.parquet]")


ONE_SCAN = [
    "silver_sales", "rpt_enrich", "rpt_sales_by_year", "rpt_monthly_trend", "rpt_category_revenue", "rpt_top_products",
    "rpt_territory", "rpt_customer_segment", "chart_revenue_by_year", "chart_category_top8", "dq_orphans", "dq_report",
]


@pytest.mark.parametrize("name", ONE_SCAN)
def test_yearly_sales_are_scanned_once(spark, name):
    assert scans(QUERIES[name](spark, FOLDER), "lineitem") == 1


def test_returns_and_references_scan_each_child_once(spark):
    assert scans(QUERIES["rpt_returns"](spark, FOLDER), "lineitem") == 2
    assert scans(QUERIES["fk_relationship_check"](spark, FOLDER), "lineitem") == 2  # sales and returns


@pytest.mark.parametrize(
    "name", ["point_lookup", "point_lookup_customer", "point_lookup_customer_name", "point_lookup_product"]
)
def test_lookups_push_the_equality_into_the_stored_files(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "PushedFilters" in text and "EqualTo(" in text
    assert "customer.parquet" not in text and "lineitem.parquet" not in text


def joins_from_the_top(spark, name: str) -> list[str]:
    """Left key of every join in the order of the plan, all by shuffles."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return re.findall(r"SortMergeJoin [^\[]*\[(\w+)#", plan(QUERIES[name](spark, FOLDER)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_wide_lines_are_shuffled_once_and_small_dimensions_come_last(spark):
    found = joins_from_the_top(spark, "vw_sales_detail")
    assert found[:6] == ["ORDER_DATE_KEY", "TERRITORY_KEY", "CUSTOMER_KEY", "PRODUCT_KEY", "PRODUCT_KEY", "ORDER_NUMBER"]
    assert joins_from_the_top(spark, "rpt_enrich")[:3] == ["TERRITORYKEY", "CUSTOMERKEY", "PRODUCTKEY"]


def test_report_datasets_are_built_from_lines_stored_once(spark, monkeypatch):
    from orefold.sources import tables

    seen, write = {}, tables.write_reports
    monkeypatch.setattr(tables, "write_reports", lambda spark, datasets, *rest: seen.update(datasets) or write(spark, datasets, *rest))
    QUERIES["report_sink"](spark, FOLDER)
    assert {name: scans(df, "lineitem") for name, df in seen.items() if scans(df, "lineitem")} == {"returns": 1}


def test_a_repeated_customer_changes_only_the_datasets_that_need_customers(spark, tmp_path):
    for name in ("region", "nation", "part", "orders", "lineitem"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{FOLDER}/{name}.parquet")
    customer = spark.read.parquet(f"{FOLDER}/customer.parquet")
    customer.unionByName(customer.withColumn("c_acctbal", F.lit(1.0))).write.parquet(str(tmp_path / "customer.parquet"))
    sums = {
        r["DATASET"]: float(r["REVENUE"])
        for r in QUERIES["report_sink"](spark, str(tmp_path)).filter("FORMAT = 'parquet'").collect()
    }
    for dataset in ("sales_by_year", "territory", "customer_segment"):
        alone = QUERIES[f"rpt_{dataset}"](spark, str(tmp_path)).agg(F.sum("REVENUE")).first()[0]
        assert sums[dataset] == pytest.approx(alone)
    assert sums["customer_segment"] > 1.5 * sums["sales_by_year"]
