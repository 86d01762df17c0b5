"""Quoted line breaks, stray quotes and rejects in files that many tasks read; tables replaced as a whole."""

import csv
import io
import random
import re

import pytest

from orefold import schemas
from orefold.sources import delimited, records, tables, versions

HEADER = "SalesTerritoryKey,Region,Country,Continent\n"
REGISTRY = {"t.csv": "BRONZE_TERRITORY"}
SCHEMA = schemas.BRONZE["BRONZE_TERRITORY"]


@pytest.fixture
def small_splits(spark):
    """Splits of a few hundred bytes, so that even small files are read by many tasks."""
    before = {}
    for key, value in {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0"}.items():
        before[key] = spark.conf.get(key)
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def load(spark, tmp_path, content, **options):
    (tmp_path / "t.csv").write_bytes(content if isinstance(content, bytes) else content.encode())
    (report,) = tables.load_sources(spark, str(tmp_path), str(tmp_path / "bronze"), REGISTRY, **options).collect()
    path = str(tmp_path / "bronze" / "BRONZE_TERRITORY")
    if report.STATUS != "LOADED":
        return report, [], []
    rows = sorted((tuple(r)[:4] for r in tables.read_table(spark, path).collect()), key=str)
    rejects = sorted(tuple(r) for r in tables.read_table(spark, path + tables.REJECTS_SUFFIX).collect())
    assert (report.ROW_COUNT, report.REJECTED_ROWS) == (len(rows), len(rejects))
    return report, rows, rejects


def test_a_stray_quote_costs_one_row(spark, tmp_path):
    rows = [f"{i},r,c,k" for i in range(1, 1001)]
    rows[100] = '101,"r,c,k'
    report, loaded, rejects = load(spark, tmp_path, HEADER + "\n".join(rows) + "\n")
    assert (report.STATUS, report.ROW_COUNT, report.REJECTED_ROWS) == ("LOADED", 999, 1)
    position = len(HEADER + "\n".join(rows[:100]) + "\n")
    assert rejects == [("t.csv", position, tables.UNCLOSED_QUOTE, '101,"r,c,k')]
    assert {r[0] for r in loaded} == set(range(1, 1001)) - {101}


@pytest.mark.parametrize("second", ['900,"r,c,k', '900,r","c,k', '900,x"y,c,"k', '900,r"r,c,k'])
def test_two_stray_quotes_far_apart_do_not_swallow_what_lies_between(spark, tmp_path, second):
    rows = [f"{i},r,c,k" for i in range(1, 1001)]
    rows[100], rows[899] = '101,"r,c,k', second
    report, loaded, rejects = load(spark, tmp_path, HEADER + "\n".join(rows) + "\n")
    assert report.ROW_COUNT + report.REJECTED_ROWS == 1000 and report.ROW_COUNT >= 998
    assert set(range(1, 1001)) - {r[0] for r in loaded} <= {101, 900}


def test_an_inch_mark_is_text_and_the_file_is_read_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "records", None)  # the careful path must not run
    report, loaded, _ = load(spark, tmp_path, HEADER + '1,12" R,c,"k ""q"" k"\n2,a,"b, b",\n')
    assert loaded == [(1, '12" R', "c", 'k "q" k'), (2, "a", "b, b", None)] and report.REJECTED_ROWS == 0


BROKEN = (
    HEADER.encode()
    + b'1,"a\n\nb ""q"",\nx",c,k\r\n'  # blank lines, quotes and commas inside
    + b'2,"a","b\nc","d\ne"\r\n'  # one value ends and the next begins on a line
    + b"\n  \n"
    + b'3,a,b\n'
    + b'4,a,b,c,d\n'
    + b'"5","a","b","c"\n'
    + b'6,a,b,"\n"\n'
    + b'x,a,b,c\n'
    + b'7,J\xc3\xb6,b,c\n'
    + b'8,"never closed,b,c\n'
    + b'9,a,b,c'
)


def test_all_kinds_of_lines(spark, tmp_path, small_splits):
    report, loaded, rejects = load(spark, tmp_path, BROKEN)
    assert loaded == sorted(
        [
            (1, 'a\n\nb "q",\nx', "c", "k"), (2, "a", "b\nc", "d\ne"), (5, "a", "b", "c"), (6, "a", "b", "\n"),
            (None, "a", "b", "c"), (7, "Jö", "b", "c"), (9, "a", "b", "c"),
        ],
        key=str,
    )
    assert report.MISFIT_ROWS == 1
    assert [(r[2], r[3]) for r in rejects] == [
        (tables.FIELDS, "3,a,b"), (tables.FIELDS, "4,a,b,c,d"), (tables.UNCLOSED_QUOTE, '8,"never closed,b,c'),
    ]
    for _, position, _, raw in rejects:
        assert BROKEN[position:].startswith(raw.encode())


def test_misfits_may_be_rejected_and_corrected_once(spark, tmp_path):
    _, loaded, rejects = load(spark, tmp_path, BROKEN, reject_misfits=True)
    assert ("x,a,b,c" in [r[3] for r in rejects]) and None not in [r[0] for r in loaded]
    path = str(tmp_path / "bronze" / "BRONZE_TERRITORY")
    fixed = {"x,a,b,c": "10,a,b,c", "3,a,b": "3,a,b,c", "4,a,b,c,d": "4,a,b"}
    rows = [("t.csv", r[1], fixed[r[3]]) for r in rejects if r[3] in fixed] + [("t.csv", 10**6, "11,not,a,reject")]
    corrections = spark.createDataFrame(rows, "SOURCE_FILE string, POSITION long, RAW_ROW string")
    header = HEADER.strip().split(",")
    for added in (2, 0):  # given again, nothing is added
        assert tables.load_corrections(spark, corrections, path, header, SCHEMA) == (added, 2)
        stored = tables.read_table(spark, path)
        assert stored.count() == len(loaded) + 2 and {3, 10} < {r[0] for r in stored.collect()}
    left = tables.read_table(spark, path + tables.REJECTS_SUFFIX).collect()
    assert {r.RAW_ROW for r in left} == {"4,a,b", '8,"never closed,b,c'}


def test_latin_files_with_quoted_breaks(spark, tmp_path):
    content = (HEADER + '1,"é\nè",ç,k\n2,a,b\n').encode("latin-1")
    report, loaded, _ = load(spark, tmp_path, content)
    assert loaded == [(1, "é\nè", "ç", "k")] and report.REJECTED_ROWS == 1


def random_file(draw, n):
    words = ["a", "b,c", 'd "e"', "f\ng", "h\n\ni,", "", "j'k", '12" l', "\n"]
    rows = [[str(i), *[draw.choice(words) for _ in range(3)]] for i in range(n)]
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(rows)
    return rows, HEADER + out.getvalue()


@pytest.mark.parametrize("seed", range(2))
def test_many_quoted_breaks_over_many_splits_match_the_csv_module(spark, tmp_path, small_splits, seed):
    rows, content = random_file(random.Random(seed), 400)
    report, loaded, _ = load(spark, tmp_path, content + "401,only two\n")
    assert report.REJECTED_ROWS == 1
    clean = lambda v: v.strip() or None  # noqa: E731  blanks at the ends go, empty values are null
    assert [(r[0], *[(v or "").strip() or None for v in r[1:]]) for r in loaded] == sorted(
        ((int(r[0]), *map(clean, r[1:])) for r in rows), key=str
    )
    assert spark.read.text(str(tmp_path / "t.csv")).rdd.getNumPartitions() > 10


def test_the_plan_of_the_records_has_no_window_over_a_whole_file_of_lines(spark, tmp_path, small_splits):
    """Windows over lines are per block, windows over events per bucket; only blocks and buckets are added up by file."""
    (tmp_path / "t.csv").write_text(random_file(random.Random(9), 200)[1])
    measured = records._measured(records.lines(spark, str(tmp_path / "t.csv"), "UTF-8"), records.Shapes(",", '"'))
    plan = measured._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(_FILE#\d+, _BLOCK#", plan)
    assert measured.select(records.BLOCK).distinct().count() > 10


def test_lines_with_very_many_quotes(spark, tmp_path):
    value = 'x ""y"" ' * 1500
    report, loaded, _ = load(spark, tmp_path, HEADER + f'1,"{value}\n{value}",c,k\n2,"{value}",c,k\n3,a,b\n')
    assert (report.STATUS, report.ROW_COUNT, report.REJECTED_ROWS) == ("LOADED", 2, 1)
    assert loaded[0][1] == f"{value}\n{value}".replace('""', '"')


def test_empty_and_header_only_files(spark, tmp_path):
    assert load(spark, tmp_path, "")[0].STATUS == "FAILED"
    report, loaded, rejects = load(spark, tmp_path, HEADER)
    assert (report.STATUS, loaded, rejects) == ("LOADED", [], [])
    report, loaded, _ = load(spark, tmp_path, HEADER + "1,a,b,c\n" + HEADER)  # a header line further down is a row
    assert len(loaded) == 2 and report.MISFIT_ROWS == 1


def test_a_folder_of_files_must_share_one_header(spark, tmp_path):
    folder = tmp_path / "t.csv"
    folder.mkdir()
    (folder / "a.csv").write_text(HEADER + '1,"a\nb",c,k\n')
    (folder / "b.csv").write_text(HEADER + "2,a,c,k\n3,x\n")
    (report,) = tables.load_sources(spark, str(tmp_path), str(tmp_path / "bronze"), REGISTRY).collect()
    assert (report.STATUS, report.ROW_COUNT, report.REJECTED_ROWS) == ("LOADED", 2, 1)
    (folder / "b.csv").write_text("Region,SalesTerritoryKey,Country,Continent\nr,2,c,k\n")
    (report,) = tables.load_sources(spark, str(tmp_path), str(tmp_path / "bronze"), REGISTRY).collect()
    assert report.STATUS == "FAILED" and "another header" in report.ERROR
    assert tables.read_table(spark, str(tmp_path / "bronze" / "BRONZE_TERRITORY")).count() == 2


# Tables replaced as a whole


def test_a_writer_that_stops_at_any_step_leaves_the_old_state(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.full_refresh(spark.range(5), path)
    for step in ("commit", "create", "delete"):
        with monkeypatch.context() as patch:
            patch.setattr(versions, step, lambda *a: (_ for _ in ()).throw(OSError("stopped")))
            if step == "delete":
                tables.full_refresh(spark.range(6), path)  # nothing to delete yet
            with pytest.raises(OSError):
                tables.full_refresh(spark.range(7), path)
        assert tables.read_table(spark, path).count() == (7 if step == "delete" else 5)
    tables.full_refresh(spark.range(8), path)
    assert tables.read_table(spark, path).count() == 8


def test_a_reader_keeps_its_state_over_one_refresh_and_older_ones_go(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.full_refresh(spark.range(1), path)
    opened = tables.read_table(spark, path)
    tables.full_refresh(spark.range(2), path)
    assert opened.count() == 1
    for n in range(3, 6):
        tables.full_refresh(spark.range(n), path)
    assert len([name for name in versions.names(spark, path) if name.startswith("v-")]) == 2
    assert len(versions.pointers(spark, path)) == 2


def test_two_writers_at_once_leave_one_whole_state(spark, tmp_path):
    path = str(tmp_path / "t")
    jobs = [lambda n=n: tables.full_refresh(spark.range(n), path) for n in (3, 4)]
    tables.side_by_side(jobs, 2)
    assert tables.read_table(spark, path).count() in (3, 4)


def test_header_fields_and_positions(spark, tmp_path):
    (tmp_path / "t.csv").write_text("﻿Sales Territory Key,,Region (x)\n")
    header = delimited.header_of(spark, str(tmp_path / "t.csv"))
    assert [delimited.normalized_name(h) for h in header] == ["SALES_TERRITORY_KEY", "", "REGION_X"]
