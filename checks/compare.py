"""Run queries and their SQL over one folder of tables and compare the rows: python -m checks.compare DIR [name ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

from checks.oracles import ORACLES
from checks.queries import QUERIES
from orefold.session import local_session


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def rows_of(columns, rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    found = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(found, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


def difference(spark, con, folder: str, name: str) -> str | None:
    """None if both sides agree in columns, types of values, row count and every value."""
    df = QUERIES[name](spark, folder)
    names, ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return None if ours else "no rows"
    cursor = con.execute(ORACLES[name])
    expected_names = [d[0] for d in cursor.description]
    expected_names, theirs = rows_of(expected_names, cursor.fetchall())
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for left, right in zip(ours, theirs):
        if left != right or [type(v) for v in left] != [type(v) for v in right]:
            bad = [(n, a, b) for n, a, b in zip(names, left, right) if a != b or type(a) is not type(b)]
            return f"first difference {bad} in {left}"
    return None


def main() -> int:
    folder, wanted = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark, con, failed = local_session(8, "compare"), connect(folder), 0
    for name in wanted:
        started = time.monotonic()
        try:
            problem = difference(spark, con, folder, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        note = "" if name in ORACLES else " (rows only)"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name}{note} {time.monotonic() - started:.1f}s {problem or ''}", flush=True)
    print(f"{len(wanted) - failed} of {len(wanted)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(min(main(), 1))
