"""Clustering by several keys, totals in two levels, and the monthly aggregate refreshed by month."""

import datetime
import os
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.queries import clustering_facts
from orefold import schemas, session
from orefold.operators import layout, silver
from orefold.plans import views
from orefold.sources import tables
from orefold.sources.starfeed import StarFeed




@pytest.fixture(scope="module")
def curved(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("layout") / "t")
    df = spark.range(40_000, numPartitions=4).selectExpr(
        "date_add(DATE'2020-01-01', int(id * 7919 % 1000)) AS day", "concat('t', lpad(string(id * 31 % 40), 2, '0')) AS place",
        "CASE WHEN id % 3 = 0 THEN 77 ELSE id * 104729 % 5000 END AS product",
    )
    layout.clustered_write(df, path, ["day", "place", "product"], files=64, curved=True)
    return path, df


def test_a_filter_on_any_key_reads_fewer_than_half_of_the_files(spark, curved):
    path, df = curved
    stored = spark.read.parquet(path)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, df.collect()))
    files = len(stored.inputFiles())
    ranges = stored.groupBy("_metadata.file_path").agg(
        *[f(c).alias(f"{n}_{c}") for c in ("day", "place", "product") for n, f in (("low", F.min), ("high", F.max))]
    ).collect()
    assert len(ranges) == files > 32
    for key, values in (("day", [datetime.date(2020, 3, 1), datetime.date(2022, 1, 1)]), ("place", ["t03", "t25"]), ("product", [5, 4990])):
        for value in values:
            kept = sum(r[f"low_{key}"] <= value <= r[f"high_{key}"] for r in ranges)
            assert 0 < kept < files / 2, (key, value, kept, files)


def test_a_hot_value_is_spread_over_files(spark, curved):
    stored = spark.read.parquet(curved[0])
    hot = stored.filter("product = 77").groupBy("_metadata.file_path").count()
    assert hot.count() > 5 and hot.agg(F.max("count")).first()[0] < 40_000 / 10


def test_curve_takes_bits_in_turns(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 0), (1, 1), (2, 0), (3, 3)], "a int, b int")
    places = [r[0] for r in df.select(layout.curve([F.col("a"), F.col("b")], 2)).collect()]
    assert places == [0, 1, 2, 3, 8, 15]


def test_ranks_of_nulls_strings_and_few_values(spark):
    df = spark.createDataFrame([(None, None), ("a", 1), ("b", 1), ("b", 1), ("c", 1)], "s string, n long")
    ranks = df.select("s", *[r.alias(f"r{i}") for i, r in enumerate(layout.key_ranks(df, ["s", "n"], 2))]).collect()
    by_value = {r["s"]: r["r0"] for r in ranks}
    assert by_value[None] == 0 and by_value["a"] <= by_value["b"] <= by_value["c"] and by_value["a"] < by_value["c"]
    assert {r["r1"] for r in ranks if r["s"]} == {1}
    assert layout.key_ranks(df.limit(0), ["s"])[0] is not None


def test_running_totals_over_many_ranges(spark):
    df = spark.range(3000).selectExpr("id * 37 % 3001 AS k", "id % 5 AS v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = layout.running_totals(df, "k", ["v"])
        plan = found._jdf.queryExecution().executedPlan().toString()
        rows = sorted(map(tuple, found.collect()))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    total, expected = 0, []
    for k, v in sorted(map(tuple, df.collect())):
        total += v
        expected.append((k, total))
    assert rows == expected
    assert "rangepartitioning" not in plan and "hashpartitioning(_RANGE" in plan  # ranges are stored, windows run in them


def test_depth_over_all_keys(spark, curved):
    depth = {r.KEY: r for r in layout.clustering_depth(spark.read.parquet(curved[0]), ["day", "place", "product"]).collect()}
    assert set(depth) == {"day", "place", "product"}
    for key in ("day", "place"):  # a third of the rows have one product
        assert depth[key].MEAN_OVERLAPS < (depth[key].FILES - 1) / 2, key


def test_facts_of_files_in_a_single_order(spark, tmp_path):
    layout.clustered_write(spark.range(3000).selectExpr("id % 40 AS k"), str(tmp_path / "t"), ["k"], files=9)
    report = layout.clustering_report(spark.read.parquet(str(tmp_path / "t")), "k")
    assert tuple(clustering_facts(report).first()) == (3000, 0, 39, True)


DAYS = [datetime.date(2021, 1, 1) + datetime.timedelta(days=i) for i in range(120)]


@pytest.fixture
def star(spark):
    dim_date = spark.createDataFrame(
        [(d, d.year, d.month, d.strftime("%B")) for d in DAYS], "DATE_KEY date, YEAR int, MONTH_NUM int, MONTH_NAME string"
    )

    def fact(rows):
        return spark.createDataFrame(
            [(DAYS[d], o, 1, r, r / 2) for d, o, r in rows],
            "ORDER_DATE_KEY date, ORDER_NUMBER long, ORDER_QUANTITY long, GROSS_REVENUE double, GROSS_PROFIT double",
        ).selectExpr("* EXCEPT (GROSS_REVENUE, GROSS_PROFIT)", "cast(GROSS_REVENUE as decimal(18,4)) AS GROSS_REVENUE", "cast(GROSS_PROFIT as decimal(18,4)) AS GROSS_PROFIT")

    return dim_date, fact


def stored_months(path):
    return {p.parent.relative_to(path).as_posix() + "/" + p.name: os.stat(p).st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_a_late_line_rewrites_one_month_and_a_deleted_one_may_remove_it(spark, tmp_path, star):
    dim_date, fact = star
    path, lines = str(tmp_path / "mv"), [(d, d, 10.0 + d) for d in range(0, 120, 3)]

    def same_as_full(rows):
        full = views.monthly_revenue(fact(rows), dim_date)
        stored = spark.read.schema(full.schema).parquet(path).select(full.columns)
        assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, full.collect()))

    assert tables.refresh_monthly_revenue(path, fact(lines), dim_date, fact(lines)) == 4
    same_as_full(lines)
    before = stored_months(path)
    late = [(40, 999, 5.0)]
    assert tables.refresh_monthly_revenue(path, fact(lines + late), dim_date, fact(late)) == 1
    same_as_full(lines + late)
    after = stored_months(path)
    changed = {name.rpartition("/")[0] for name in set(before) ^ set(after)}
    assert changed == {"YEAR=2021/MONTH_NUM=2"}
    gone = [row for row in lines if DAYS[row[0]].month == 3]
    left = [row for row in lines + late if row not in gone]
    assert tables.refresh_monthly_revenue(path, fact(left), dim_date, fact(gone)) == 1
    same_as_full(left)
    assert tables.refresh_monthly_revenue(path, fact(left), dim_date, fact([]).limit(0)) == 0


def test_monthly_refresh_reads_the_fact_by_date(spark, star):
    dim_date, fact = star
    plan = views.monthly_revenue_of(fact([(1, 1, 1.0)]), dim_date, [(2021, 2)])._jdf.queryExecution().optimizedPlan().toString()
    assert "ORDER_DATE_KEY" in plan and "2021-02-01" in plan and "2021-02-28" in plan


def test_a_rank_is_the_number_of_bounds_not_above(spark):
    bounds = [3, 5, 8, 13, 21, 34, 55]
    df = spark.createDataFrame([(i,) for i in [None, *range(60)]], "v long")
    found = df.select("v", layout._rank(F.col("v"), [F.lit(b) for b in bounds]).alias("r")).collect()
    assert all(r["r"] == (0 if r["v"] is None else sum(b <= r["v"] for b in bounds)) for r in found)


def test_tables_are_stored_side_by_side_as_one_by_one(spark, tmp_path):
    from threading import Barrier

    together = Barrier(3, timeout=60)

    class Waiting(dict):
        """Its tables are asked for their keys by all three at once, or not at all."""

        def get(self, name, default=None):
            together.wait()
            return default

    built = {name: spark.range(n).withColumn("name", F.lit(name)) for name, n in (("a", 3), ("b", 5), ("c", 0))}
    keys = tables.schemas.CLUSTER_KEYS
    tables.schemas.CLUSTER_KEYS = Waiting()
    try:
        stored = tables.refresh_tables(spark, str(tmp_path), built)
    finally:
        tables.schemas.CLUSTER_KEYS = keys
    assert list(stored) == ["a", "b", "c"]
    assert {name: sorted(r["id"] for r in df.collect()) for name, df in stored.items()} == {"a": [0, 1, 2], "b": [0, 1, 2, 3, 4], "c": []}


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for folder in folders for f in Path(folder).rglob("shuffle_*.data")}


def sales_lines(spark):
    return spark.createDataFrame(
        [("a", "2020-01-04", "2020-01-01"), ("b", "bad", "2020-01-01"), ("c", None, None), ("a", "2020-01-03", "2020-01-05"), (None, "2020-01-04", None)],
        "ORDERNUMBER string, ORDERDATE string, STOCKDATE string",
    ).selectExpr(
        "*", "3L AS ORDERLINEITEM", "5L AS PRODUCTKEY", "7L AS CUSTOMERKEY", "CAST(null AS long) AS TERRITORYKEY", "9L AS ORDERQUANTITY",
        "2020 AS FILE_YEAR", "'f' AS SOURCE_FILE",
    ).repartition("ORDERNUMBER")


def test_stored_tables_leave_no_shuffles_behind(spark, tmp_path):
    conf = {key: spark.conf.get(key) for key in (session._FREED, session._READ)}
    held = spark.range(100).repartition("id")  # a shuffle that may not go by collection of garbage while files are compared
    held.collect()
    before = shuffle_files(spark)
    stored = tables.refresh_tables(
        spark, str(tmp_path), {"SILVER_SALES": silver.cleansed_sales(sales_lines(spark)), "OTHER": spark.range(9).repartition("id")},
        in_turn=("SILVER_SALES",), completed={"SILVER_SALES": silver.completed_sales},
    )
    left = time.monotonic() + 20
    while shuffle_files(spark) - before and time.monotonic() < left:
        time.sleep(0.1)
    assert before and not shuffle_files(spark) - before
    assert {key: spark.conf.get(key) for key in conf} == conf
    assert held.count() == 100 and [df.count() for df in stored.values()] == [4, 9]


def test_columns_that_follow_from_others_are_added_to_ordered_rows(spark, tmp_path, monkeypatch):
    seen, write = [], layout.clustered_write
    monkeypatch.setattr(layout, "clustered_write", lambda df, *args, **options: (seen.append(df.columns), write(df, *args, **options)))
    found = tables.refresh_tables(
        spark, str(tmp_path), {"SILVER_SALES": silver.cleansed_sales(sales_lines(spark))}, completed={"SILVER_SALES": silver.completed_sales}
    )["SILVER_SALES"]
    assert "DAYS_FROM_STOCK_TO_ORDER" not in seen[0] and tables.LOAD_TIMESTAMP not in seen[0]
    whole = silver.sales_of_years(sales_lines(spark))
    assert found.columns == [*whole.columns, tables.LOAD_TIMESTAMP] == [*schemas.SILVER["SILVER_SALES"].names, tables.LOAD_TIMESTAMP]
    assert sorted(found.drop(tables.LOAD_TIMESTAMP).collect(), key=str) == sorted(whole.collect(), key=str)
    assert {r.DAYS_FROM_STOCK_TO_ORDER for r in found.collect()} == {3, -2, None}


def test_large_tables_are_stored_one_after_another_beside_the_others(spark, tmp_path, monkeypatch):
    running, most, refresh = set(), [], tables.refresh_table

    def watched(spark, root, name, *args):
        running.add(name)
        most.append({"x", "y", "z"} & running)
        time.sleep(0.3)
        stored = refresh(spark, root, name, *args)
        running.discard(name)
        return stored

    monkeypatch.setattr(tables, "refresh_table", watched)
    built = {name: spark.range(n) for n, name in enumerate("axbyz")}
    stored = tables.refresh_tables(spark, str(tmp_path), built, in_turn=("z", "x", "y"))
    assert list(stored) == list(built) and [df.count() for df in stored.values()] == [0, 1, 2, 3, 4]
    assert max(map(len, most)) == 1 and [next(iter(m)) for m in most if m][:1] == ["z"]


def test_the_whole_sales_fact_is_its_priced_lines_completed(spark, tmp_path):
    """Lines without an order or a product, and repeated ones, stay; what is shuffled last has no measures."""
    put = {
        "lineitem": spark.createDataFrame(
            [(1, 1, 10, 2.0, "2020-01-05"), (1, 1, 10, 2.0, "2020-01-05"), (2, 1, 99, 3.0, "2020-01-05"), (9, 1, 10, 1.0, None), (None, None, None, None, None)],
            "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_shipdate string",
        ).withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz")),
        "orders": spark.sql("SELECT * FROM VALUES (1L, 4L, timestamp_ntz'2020-01-02'), (2L, 5L, null) t(o_orderkey, o_custkey, o_orderdate)"),
        "customer": spark.sql("SELECT 4L AS c_custkey, 3 AS c_nationkey"),
        "part": spark.sql("SELECT 10L AS p_partkey, 'a b' AS p_name, 'Brand#12' AS p_brand, 'PROMO' AS p_type, 25 AS p_size, 10.0D AS p_retailprice"),
    }
    for name, df in put.items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    feed = StarFeed(spark, str(tmp_path))
    assert not {"GROSS_REVENUE", "TOTAL_COST", "GROSS_PROFIT", "SALES_YEAR", "LEAD_TIME_DAYS"} & set(feed.priced_sales().columns)
    found = sorted((r.asDict() for r in feed.fact_sales().collect()), key=str)
    assert [*found[0]] == schemas.GOLD["FACT_SALES"].names and len(found) == 5
    by_order = {r["ORDER_NUMBER"]: r for r in found}
    first = by_order[1]
    assert (first["SALES_YEAR"], first["LEAD_TIME_DAYS"], first["TERRITORY_KEY"]) == (2020, -3, 3)
    assert first["GROSS_REVENUE"] == 2 * first["UNIT_PRICE"] == 20 and first["GROSS_PROFIT"] == first["GROSS_REVENUE"] - first["TOTAL_COST"]
    assert (by_order[2]["GROSS_REVENUE"], by_order[2]["SALES_YEAR"], by_order[2]["CUSTOMER_KEY"]) == (0, None, 5)
    assert by_order[9]["GROSS_REVENUE"] == 10 and by_order[9]["CUSTOMER_KEY"] is None and by_order[None]["GROSS_REVENUE"] is None
    every = feed.fact_sales(*schemas.GOLD["FACT_SALES"].names)  # prices before orders
    assert sorted((r.asDict() for r in every.collect()), key=str) == found
