import gzip
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks.queries import clustering_facts
from orefold import schemas, session
from orefold.operators import layout
from orefold.sources import delimited, tables


def put(folder, name, content, encoding="utf-8"):
    path = folder / name
    path.write_bytes(content.encode(encoding))
    return str(path)


def test_scan_strips_bom_and_nulls_tokens(spark, tmp_path):
    path = put(tmp_path, "t.csv", '﻿SalesTerritoryKey,Region,Country,Continent\n1, "North, west" ,N/A,NULL\n2,null,, x \nq,a,b,c\n')
    found = delimited.scan(spark, path, schemas.BRONZE["BRONZE_TERRITORY"]).collect()
    assert [tuple(r) for r in found] == [(1, "North, west", None, None), (2, None, None, "x"), (None, "a", "b", "c")]


def test_scan_keeps_quotes_within_quotes(spark, tmp_path):
    path = put(tmp_path, "c.csv", 'ProductCategoryKey,CategoryName\n1,"a ""b"" c"\n')
    assert delimited.scan(spark, path, schemas.BRONZE["BRONZE_PRODUCT_CATEGORY"]).first().CATEGORYNAME == 'a "b" c'


def test_tolerant_load_splits_good_and_rejected(spark, tmp_path):
    path = put(tmp_path, "r.csv", "ReturnDate,TerritoryKey,ProductKey,ReturnQuantity\n2020-01-01,1,2,3\n2020-01-01,1,2\n2020-01-01,x,2,3\n2020-01-01,N/A,2,3\na,1,2,3,4\n")
    good, rejected = delimited.tolerant_load(spark, path, schemas.BRONZE["BRONZE_RETURNS"])
    assert good.count() == 2 and good.select("PRODUCTKEY").count() == 2
    assert sorted(r.TERRITORYKEY or 0 for r in good.collect()) == [0, 1]
    reasons = sorted(r[delimited.REASON] for r in rejected.collect())
    assert reasons == ["TERRITORYKEY is not bigint", "wrong number of fields", "wrong number of fields"]
    assert "2020-01-01,x,2,3" in [r[delimited.RAW_ROW] for r in rejected.collect()]


def test_encoding_detection(spark, tmp_path):
    latin = put(tmp_path, "l.csv", "ProductCategoryKey,CategoryName\n1,Vélo\n", "latin-1")
    utf = put(tmp_path, "u.csv", "ProductCategoryKey,CategoryName\n1,Vélo\n")
    for path, expected in ((latin, delimited.LATIN1), (utf, delimited.UTF8)):
        found = delimited.detect_encoding(spark, path)
        assert found == expected
        fmt = delimited.Format(encoding=found)
        assert delimited.scan(spark, path, schemas.BRONZE["BRONZE_PRODUCT_CATEGORY"], fmt).first().CATEGORYNAME == "Vélo"


def test_column_names():
    assert delimited.normalized_name("North Region (Units)") == "NORTH_REGION_UNITS"


def test_load_report_goes_on_after_missing_and_broken_files(spark, tmp_path):
    put(tmp_path, "Territory Lookup.csv", "SalesTerritoryKey,Region,Country,Continent\n1,a,b,c\n2,a,b,c\n")
    broken = gzip.compress(b"ProductKey\n" + bytes(range(256)) * 50)[:-40]
    (tmp_path / "Returns Data.csv.gz").write_bytes(broken)
    registry = {"Returns Data.csv.gz": "BRONZE_RETURNS", "Territory Lookup.csv": "BRONZE_TERRITORY", "none.csv": "BRONZE_CALENDAR"}
    report = tables.load_sources(spark, str(tmp_path), str(tmp_path / "bronze"), registry).collect()
    assert [(r.TABLE_NAME, r.STATUS, r.ROW_COUNT) for r in report] == [
        ("BRONZE_RETURNS", "FAILED", 0), ("BRONZE_TERRITORY", "LOADED", 2), ("BRONZE_CALENDAR", "SKIPPED", 0)
    ]
    stored = tables.read_table(spark, str(tmp_path / "bronze" / "BRONZE_TERRITORY"))
    row = stored.first()
    assert row.SOURCE_FILE == "Territory Lookup.csv" and row.LOAD_TIMESTAMP is not None
    assert dict(stored.dtypes)["LOAD_TIMESTAMP"] == "timestamp_ntz"


LOADED = {"t.csv": "BRONZE_TERRITORY"}


def load(spark, tmp_path, content, encoding="utf-8", registry=LOADED):
    put(tmp_path, next(iter(registry)), content, encoding)
    (report,) = tables.load_sources(spark, str(tmp_path), str(tmp_path / "bronze"), registry).collect()
    if report.STATUS != "LOADED":
        return report, []
    stored = tables.read_table(spark, str(tmp_path / "bronze" / report.TABLE_NAME))
    return report, sorted((tuple(r)[:4] for r in stored.collect()), key=str)


def test_load_finds_columns_by_header(spark, tmp_path):
    report, rows = load(
        spark, tmp_path, "Region, Country ,Extra,Continent,SalesTerritoryKey\nr,c,x,k,1\ns,d,y,l,2\n"
    )
    assert rows == [(1, "r", "c", "k"), (2, "s", "d", "l")] and report.MISFIT_ROWS == 0


def test_load_fails_without_a_declared_column(spark, tmp_path):
    report, _ = load(spark, tmp_path, "SalesTerritoryKey,Region\n1,r\n")
    assert (report.STATUS, report.ROW_COUNT) == ("FAILED", 0)
    assert "COUNTRY" in report.ERROR and "CONTINENT" in report.ERROR
    report, _ = load(spark, tmp_path, "")
    assert report.STATUS == "FAILED"


def test_load_accepts_quoted_line_breaks(spark, tmp_path):
    _, rows = load(spark, tmp_path, 'SalesTerritoryKey,Region,Country,Continent\n1,"a\nb",c,d\n2,e,f,g\n')
    assert rows == [(1, "a\nb", "c", "d"), (2, "e", "f", "g")]


def test_load_takes_the_encoding_of_the_file(spark, tmp_path):
    _, rows = load(spark, tmp_path, "SalesTerritoryKey,Region,Country,Continent\n1,José,c,d\n", "latin-1")
    assert rows == [(1, "José", "c", "d")]


def test_load_counts_rows_with_values_that_do_not_fit(spark, tmp_path):
    content = "SalesTerritoryKey,Region,Country,Continent\nx,a,b,c\n2,a,b,c\nN/A,a,b,c\n"
    report, rows = load(spark, tmp_path, content)
    assert (report.STATUS, report.ROW_COUNT, report.MISFIT_ROWS) == ("LOADED", 3, 1)


@pytest.mark.parametrize("name", ["a+b.csv", "a b.csv", "a%41.csv", "a+b%20c d.csv"])
def test_source_file_is_the_name_as_it_is(spark, tmp_path, name):
    content = "SalesTerritoryKey,Region,Country,Continent\n1,a,b,c\n"
    load(spark, tmp_path, content, registry={name: "BRONZE_TERRITORY"})
    assert tables.read_table(spark, str(tmp_path / "bronze" / "BRONZE_TERRITORY")).first().SOURCE_FILE == name


def test_refresh_may_read_the_table_it_replaces_and_keeps_it_on_failure(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.full_refresh(spark.range(5), path)
    tables.full_refresh(tables.read_table(spark, path).unionByName(spark.range(5, 7)), path)
    assert tables.read_table(spark, path).count() == 7
    failing = spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        tables.full_refresh(failing, path)
    spark.catalog.refreshByPath(path)
    assert tables.read_table(spark, path).count() == 7


def test_full_refresh_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.full_refresh(spark.range(10), path) == 10
    assert tables.full_refresh(spark.range(3), path) == 3
    assert tables.read_table(spark, path).count() == 3


def test_snapshots_and_retention(spark, tmp_path):
    path = str(tmp_path / "t")
    for day, rows in ((1, 1), (10, 2), (20, 3)):
        tables.write_snapshot(spark.range(rows), path, datetime(2020, 1, day))
    assert tables.read_as_of(spark, path, datetime(2020, 1, 15)).count() == 2
    assert tables.read_as_of(spark, path, datetime(2020, 1, 20)).columns == ["id"]
    tables.restore(spark, path, datetime(2020, 1, 5), datetime(2020, 1, 21))
    assert tables.read_as_of(spark, path, datetime(2020, 2, 1)).count() == 1
    with pytest.raises(ValueError):
        tables.read_as_of(spark, path, datetime(2019, 1, 1))
    kept = tables.within_retention(spark.read.parquet(path), "GOLD", datetime(2020, 1, 24))
    assert sorted(r[0] for r in kept.select(tables.SNAPSHOT).distinct().collect()) == [20200110000000, 20200120000000, 20200121000000]


def test_stored_tables_win_over_built_ones(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "A"))

    def build():
        return {"A": spark.range(1), "B": spark.range(2)}

    assert tables.stored_or_built(spark, str(tmp_path), ["A"], build)["A"].count() == 4
    assert tables.stored_or_built(spark, str(tmp_path), ["A", "B"], build)["A"].count() == 1


def test_clustered_files_do_not_overlap_and_split_a_hot_key(spark, tmp_path):
    cold = spark.range(2000, numPartitions=4).select((F.col("id") % 100 + 1).alias("k"), F.col("id").alias("v"))
    hot = spark.range(1000, numPartitions=4).select(F.lit(500).cast("long").alias("k"), F.lit(0).cast("long").alias("v"))
    path = str(tmp_path / "t")
    layout.clustered_write(cold.unionByName(hot), path, ["k"], files=6)
    stored = spark.read.parquet(path)
    assert stored.count() == 3000 and stored.columns == ["k", "v"]
    files = layout.clustering_report(stored, "k").collect()
    hot_files = [f for f in files if f.MAX_KEY == 500]
    assert len(hot_files) > 1 and max(f.ROW_COUNT for f in files) < 1000
    for f in files:
        others = [g for g in files if g.FILE_PATH != f.FILE_PATH and g.MIN_KEY <= f.MAX_KEY and g.MAX_KEY >= f.MIN_KEY]
        assert f.OVERLAPS == len(others)


def test_scratch_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    path = session.scratch_path(spark, "x")
    assert path.startswith((root or spark.conf.get("spark.checkpoint.dir")).rstrip("/"))
    assert path != session.scratch_path(spark, "x")


def test_refreshed_tables_carry_their_load_time(spark, tmp_path):
    stored = tables.refresh_table(spark, str(tmp_path), "DIM_X", spark.range(3))
    assert stored.columns == ["id", "LOAD_TIMESTAMP"] and stored.filter("LOAD_TIMESTAMP IS NULL").isEmpty()


@pytest.mark.parametrize(
    "rows, counted",
    [
        ([(1, 3, 1), (3, 5, 1)], True),
        ([(1, 3, 1), (3, 3, 2), (3, 5, 2)], False),  # counts are wrong
        ([(1, 3, 2), (3, 3, 2), (3, 5, 2)], True),
        ([(1, 4, 1), (3, 5, 1)], False),  # more than the boundary key in common
        ([(1, 3, 0), (4, 5, 0)], True),
    ],
)
def test_clustering_facts_see_wrong_counts_and_wide_overlaps(spark, rows, counted):
    files = spark.createDataFrame([(*r, 10) for r in rows], "MIN_KEY long, MAX_KEY long, OVERLAPS long, ROW_COUNT long")
    assert clustering_facts(files).first().COUNTED is counted
