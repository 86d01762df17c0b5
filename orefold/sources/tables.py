"""Stored tables: full refresh, snapshots and retention, load reports, report files."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import datetime, timedelta
from functools import partial
from itertools import chain
from time import monotonic
from typing import TypeVar

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orefold import schemas, session
from orefold.operators import layout
from orefold.plans import views
from orefold.sources import delimited, records, versions

T = TypeVar("T")
SNAPSHOT = "snapshot_ts"
LOAD_TIMESTAMP = "LOAD_TIMESTAMP"
_SNAPSHOT_FORMAT = "%Y%m%d%H%M%S"

LOAD_REPORT_DDL = "TABLE_NAME string, STATUS string, ROW_COUNT long, MISFIT_ROWS long, REJECTED_ROWS long, ERROR string"
LOADED, SKIPPED, FAILED = "LOADED", "SKIPPED", "FAILED"


REJECT_REASON, UNCLOSED_QUOTE, FIELDS = delimited.REASON, "quoted value without an end", "wrong number of fields"
REJECTS_SUFFIX = "_REJECTS"
exists, read_table, store = versions.exists, versions.read, records.store


def full_refresh(df: DataFrame, path: str) -> int:
    """Replace the stored table once the new state is written; returns the rows, counted while writing.

    A failed write leaves the table as it was, and ``df`` may read the table that it replaces. Read it by ``read_table``.
    """
    rows, version = Observation(), versions.new_version(path)
    df.observe(rows, F.count(F.lit(1)).alias("ROW_COUNT")).write.parquet(version)
    versions.commit(df.sparkSession, path, version)
    return rows.get["ROW_COUNT"]


def _audited(rows: DataFrame, schema: StructType) -> DataFrame:
    named = delimited.file_name(F.element_at(F.split(records.FILE, "/"), -1))
    return rows.select(*schema.names, F.localtimestamp().alias(LOAD_TIMESTAMP), named.alias("SOURCE_FILE"))


def _load_clean(spark: SparkSession, source: str, version: str, header: list[str], schema: StructType, fmt: delimited.Format):
    """Write the rows of a file that needs no care, in one pass over its lines; returns what was seen on the way.

    Rows are right if every line is a record: no quoted value is open at its end, all are valid in the encoding, all have
    the fields of the header, and every file began with it.
    """
    shapes = records.Shapes(fmt.delimiter, fmt.quote)
    lines = spark.read.option("lineSep", "\n").text(source).select(
        F.col("_metadata.file_path").alias(records.FILE), F.col("_metadata.file_block_start").alias("_AT"), "value"
    )
    lines = lines.select(
        records.FILE, "_AT", (~F.is_valid_utf8("value")).alias(delimited.INVALID),
        records.line_text("value", fmt.encoding).alias(records.RAW),
    ).filter(F.trim(records.RAW) != "")
    judged = delimited.parsed(lines.withColumn(records.UNCLOSED, shapes.opens(F.col(records.RAW))), records.RAW, header, schema, fmt)
    is_header = F.col(delimited.HEADER) & (F.col("_AT") == 0)
    seen = Observation()
    counted = judged.observe(
        seen,
        F.count(F.lit(1)).alias("LINES"),
        F.count_if(is_header).alias("HEADERS"),
        F.count_if(F.col(delimited.MISFIT).isNotNull() & ~is_header).alias("MISFITS"),
        F.count_if(F.col(records.UNCLOSED)).alias("UNCLOSED"),
        F.count_if(F.col(delimited.CORRUPT)).alias("CORRUPT"),
        F.count_if(F.col(delimited.INVALID)).alias("INVALID"),
    )
    _audited(counted.filter(~is_header), schema).write.parquet(version)
    return seen.get


def _judged_records(
    spark: SparkSession, source: str, header: list[str], schema: StructType, fmt: delimited.Format, reject_misfits: bool
) -> DataFrame:
    """All records of the files but their headers, with the reason why a record can't be loaded (null if it can)."""
    found = records.records(spark, source, fmt.delimiter, fmt.quote, fmt.encoding, len(header))
    judged = delimited.parsed(found, records.RAW, header, schema, fmt)
    # Raises where it is evaluated, so no rows of a file with another header are ever put in place.
    other = F.raise_error(F.concat(F.lit("another header than in the first file: "), F.col(records.FILE)))
    first = F.col(records.POSITION) == 0
    rows = judged.filter(F.when(first & ~F.col(delimited.HEADER), other.cast("boolean")).otherwise(~first))
    reason = F.when(F.col(records.UNCLOSED), UNCLOSED_QUOTE).when(F.col(delimited.CORRUPT), FIELDS)
    return rows.withColumn(REJECT_REASON, reason.otherwise(F.col(delimited.MISFIT)) if reject_misfits else reason)


def load_table(
    spark: SparkSession, source: str, path: str, schema: StructType, fmt: delimited.Format, reject_misfits: bool = False
) -> tuple[int, int, int]:
    """Load a file (or a folder of them) into its raw table; returns rows, rows with a value that did not fit, rejected rows.

    The file is read once if it is clean. If a line leaves a quoted value open, is not UTF-8 or has another number of fields,
    its records are found anew with their positions (see ``records``) and those that can't be loaded go to the table of
    rejects beside it, with file, byte position, reason and text: every record is in one of the two. Values that don't fit
    their type become null and are counted; with ``reject_misfits`` their rows are rejects too.
    """
    schema = schemas.nullable(schema)
    header = delimited.header_of(spark, source, fmt)
    delimited.positions(header, schema)
    rejects, version = f"{path}{REJECTS_SUFFIX}", versions.new_version(path)
    seen = _load_clean(spark, source, version, header, schema, fmt)
    n_files = len(spark.read.text(source).inputFiles())
    dirty = seen["UNCLOSED"] + seen["CORRUPT"] + seen["INVALID"] + (seen["MISFITS"] if reject_misfits else 0)
    if not dirty and seen["HEADERS"] == n_files:
        versions.commit(spark, path, version)
        full_refresh(spark.createDataFrame([], REJECTS_DDL), rejects)
        return seen["LINES"] - seen["HEADERS"], seen["MISFITS"], 0
    versions.delete(spark, version)
    if seen["INVALID"]:
        fmt = replace(fmt, encoding=delimited.LATIN1)
        header = delimited.header_of(spark, source, fmt)
    judged = records.store(_judged_records(spark, source, header, schema, fmt, reject_misfits), "judged-records")
    refused = F.col(REJECT_REASON).isNotNull()
    named = delimited.file_name(F.element_at(F.split(records.FILE, "/"), -1)).alias("SOURCE_FILE")
    n_rejected = full_refresh(
        judged.filter(refused).select(named, records.POSITION, REJECT_REASON, records.RAW), rejects
    )
    rows, version = Observation(), versions.new_version(path)
    counted = judged.filter(~refused).observe(
        rows, F.count(F.lit(1)).alias("ROW_COUNT"), F.count_if(F.col(delimited.MISFIT).isNotNull()).alias("MISFITS")
    )
    _audited(counted, schema).write.parquet(version)
    versions.commit(spark, path, version)
    return rows.get["ROW_COUNT"], rows.get["MISFITS"], n_rejected


REJECTS_DDL = "SOURCE_FILE string, POSITION long, REJECT_REASON string, RAW_ROW string"


def load_corrections(
    spark: SparkSession,
    corrections: DataFrame,
    path: str,
    header: list[str],
    schema: StructType,
    fmt: delimited.Format = delimited.Format(),
) -> tuple[int, int]:
    """Add corrected rejects to their table; returns how many were added and how many rejects are left.

    ``corrections`` has SOURCE_FILE, POSITION and the corrected RAW_ROW. One that is not (or no longer) among the rejects is
    ignored and of several for one reject the least text counts, so no row is loaded twice; one that still can't be loaded
    stays rejected, with its new text and reason.
    """
    schema = schemas.nullable(schema)
    known = read_table(spark, f"{path}{REJECTS_SUFFIX}")
    key = ["SOURCE_FILE", records.POSITION]
    given = corrections.groupBy(*key).agg(F.min(records.RAW).alias(records.RAW))
    judged = delimited.parsed(known.select(*key).join(given, key), records.RAW, header, schema, fmt)
    shapes = records.Shapes(fmt.delimiter, fmt.quote)
    reason = F.when(shapes.opens(F.col(records.RAW)), UNCLOSED_QUOTE).when(F.col(delimited.CORRUPT), FIELDS)
    judged = records.store(judged.withColumn(REJECT_REASON, reason.otherwise(F.col(delimited.MISFIT))), "judged-corrections")
    good = judged.filter(F.col(REJECT_REASON).isNull())
    added = good.select(*schema.names, F.localtimestamp().alias(LOAD_TIMESTAMP), "SOURCE_FILE")
    still = judged.filter(F.col(REJECT_REASON).isNotNull()).select(*known.columns)
    left = known.join(judged.select(*key), key, "left_anti").select(*known.columns).unionByName(still)
    n_added = good.count()
    full_refresh(read_table(spark, path).unionByName(added), path)
    return n_added, full_refresh(left, f"{path}{REJECTS_SUFFIX}")


def refresh_table(
    spark: SparkSession, root: str, name: str, df: DataFrame, completed: Callable[[DataFrame], DataFrame] = layout.as_is
) -> DataFrame:
    """Build a table from its query, stamped with the load time, and read it back; clustered tables keep their order.

    ``completed`` adds columns that follow from others of a row, as late as it can be.
    """
    path = f"{root}/{name}"
    version = versions.new_version(path)
    keys = schemas.CLUSTER_KEYS.get(name)

    def stamped(rows: DataFrame) -> DataFrame:
        return completed(rows).withColumn(LOAD_TIMESTAMP, F.localtimestamp())

    if keys:
        # Stored first: dealing rows out by range samples its input, which then is a scan of the keys and not the query.
        plain = f"{version}-plain"
        df.write.option("compression", layout.COMPRESSION).parquet(plain)
        stored, lookups = spark.read.parquet(plain), schemas.LOOKUP_COLUMNS.get(name, ())
        layout.clustered_write(stored, version, keys, lookup_columns=lookups, curved=len(keys) > 1, completed=stamped)
        versions.delete(spark, plain)
    else:
        stamped(df).write.parquet(version)
    versions.commit(spark, path, version)
    return read_table(spark, path)


def refresh_tables(
    spark: SparkSession,
    root: str,
    built: Mapping[str, DataFrame],
    at_once: int = 4,
    in_turn: Sequence[str] = (),
    completed: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None,
) -> dict[str, DataFrame]:
    """``refresh_table`` for several tables, ``at_once`` side by side.

    Large tables named by ``in_turn`` are stored one after another, beside the others, so that only one of them has its
    shuffles and its plain copy on disk. Shuffles go as soon as what they were for is written. ``completed`` is that of
    ``refresh_table`` by the name of a table.
    """

    def refresh(names: Sequence[str]) -> list[tuple[str, DataFrame]]:
        late = completed or {}
        return [(name, refresh_table(spark, root, name, built[name], late.get(name, layout.as_is))) for name in names]

    groups = [list(in_turn), *[[name] for name in built if name not in in_turn]]
    with session.spared_disk(spark):
        stored = dict(chain.from_iterable(side_by_side([partial(refresh, group) for group in groups], at_once)))
    return {name: stored[name] for name in built}


def load_sources(
    spark: SparkSession,
    folder: str,
    root: str,
    registry: Mapping[str, str] = schemas.SOURCE_FILES,
    fmt: delimited.Format = delimited.Format(),
    reject_misfits: bool = False,
    at_once: int = 4,
) -> DataFrame:
    """Load every registered file into its raw table; a missing or broken file does not stop the others.

    Columns are found by header, the encoding is that of the file. Returns one report row per table in the order of the
    registry; see ``load_table`` for its counts. ``at_once`` files are loaded side by side.
    """

    def load(file_name: str, table: str) -> tuple:
        path = f"{folder}/{file_name}"
        if not exists(spark, path):
            return table, SKIPPED, 0, 0, 0, "file not found"
        try:
            counts = load_table(spark, path, f"{root}/{table}", schemas.BRONZE[table], fmt, reject_misfits)
            return table, LOADED, *counts, None
        except (PySparkException, Py4JJavaError, ValueError) as error:
            return table, FAILED, 0, 0, 0, str(error).split("\n\tat ", 1)[0]

    return spark.createDataFrame(side_by_side([partial(load, *entry) for entry in registry.items()], at_once), LOAD_REPORT_DDL)


def side_by_side(jobs: Sequence[Callable[[], T]], at_once: int) -> list[T]:
    """Results of independent jobs, in order; their stages share the cluster."""
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(lambda job: job(), jobs))


def row_counts(tables: Mapping[str, DataFrame], root: str, spark: SparkSession, at_once: int = 4) -> DataFrame:
    """Build the tables, ``at_once`` side by side, and report rows and seconds for each, in order."""

    def build(name: str, df: DataFrame) -> tuple:
        started = monotonic()
        return name, full_refresh(df, f"{root}/{name}"), monotonic() - started

    report = side_by_side([partial(build, *entry) for entry in tables.items()], at_once)
    return spark.createDataFrame(report, "TABLE_NAME string, ROW_COUNT long, SECONDS double")


def write_snapshot(df: DataFrame, path: str, taken: datetime) -> None:
    """Add a full state of a table without a key as of ``taken``; see ``history`` for keyed ones."""
    stamp = int(taken.strftime(_SNAPSHOT_FORMAT))
    df.write.mode("overwrite").parquet(f"{path}/{SNAPSHOT}={stamp}")


def _latest(spark: SparkSession, path: str, upto: datetime) -> int | None:
    """Newest whole snapshot not after ``upto``, from the names of the partition folders; no file is opened."""
    names = [name for name in versions.names(spark, path) if name.startswith(f"{SNAPSHOT}=")]
    whole = [name for name in names if exists(spark, f"{path}/{name}/_SUCCESS")]
    stamps = [int(name.partition("=")[2]) for name in whole]
    return max((stamp for stamp in stamps if stamp <= int(upto.strftime(_SNAPSHOT_FORMAT))), default=None)


def read_as_of(spark: SparkSession, path: str, moment: datetime) -> DataFrame:
    """The table as it was at ``moment``; only the files of that snapshot are read."""
    stamp = _latest(spark, path, moment)
    if stamp is None:
        raise ValueError(f"no snapshot of {path} at or before {moment}")
    return spark.read.parquet(path).filter(F.col(SNAPSHOT) == stamp).drop(SNAPSHOT)


def restore(spark: SparkSession, path: str, moment: datetime, now: datetime) -> None:
    """Make the state of ``moment`` the newest one, as a further snapshot; nothing is lost."""
    write_snapshot(read_as_of(spark, path, moment), path, now)


def within_retention(table: DataFrame, layer: str, now: datetime) -> DataFrame:
    """Snapshots that the layer still keeps; the filter prunes whole partitions."""
    oldest = now - timedelta(days=schemas.RETENTION_DAYS[layer])
    return table.filter(F.col(SNAPSHOT) >= int(oldest.strftime(_SNAPSHOT_FORMAT)))


def refresh_partitions(df: DataFrame, path: str, columns: Sequence[str], asked: Sequence[tuple]) -> None:
    """Overwrite the asked partitions of a stored table with the rows of ``df``; one without rows is removed, others stay.

    ``df`` must hold rows of asked partitions only. It is evaluated once, before a partition is touched.
    """
    spark = df.sparkSession
    fresh = records.store(df.withColumn(LOAD_TIMESTAMP, F.localtimestamp()), "partitions")
    filled = {tuple(row) for row in fresh.select(*columns).distinct().collect()}
    if not filled <= set(asked):
        raise ValueError(f"rows of other partitions than asked: {sorted(filled - set(asked))}")
    fresh.repartition(*columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)
    for values in set(asked) - filled:
        versions.delete(spark, "/".join([path, *[f"{c}={v}" for c, v in zip(columns, values)]]))


def refresh_monthly_revenue(path: str, fact_sales: DataFrame, dim_date: DataFrame, changed: DataFrame) -> int:
    """Bring the stored monthly aggregate up to date with ``fact_sales``; returns the months written or removed.

    ``changed`` holds the lines that were added, altered or deleted. Only the partitions of their months are built again, from
    the fact read by date. All lines build the whole table.
    """
    months = views.months_of(changed, dim_date)
    if months:
        refresh_partitions(views.monthly_revenue_of(fact_sales, dim_date, months), path, views.MONTH, months)
    return len(months)


def stored_or_built(
    spark: SparkSession, root: str, names: list[str], build: Callable[[], dict[str, DataFrame]]
) -> dict[str, DataFrame]:
    """Stored tables if all can be read, otherwise the result of ``build``."""
    try:
        return {name: read_table(spark, f"{root}/{name}") for name in names}
    except AnalysisException:
        return build()


def query(spark: SparkSession, statement: str, **tables: DataFrame) -> DataFrame:
    """Run a SQL statement over the given tables, named as in the statement."""
    return spark.sql(statement, **tables)


def write_reports(
    spark: SparkSession, datasets: Mapping[str, DataFrame], root: str, formats: Sequence[str], at_once: int = 4
) -> dict[tuple[str, str], str]:
    """Write each report dataset in each format; returns the folder by dataset and format.

    A dataset is computed once, as parquet; the other formats are written from its stored rows. ``at_once`` datasets are
    written side by side.
    """

    def write(name: str, df: DataFrame) -> dict[tuple[str, str], str]:
        stored = f"{root}/parquet/{name}"
        df.write.mode("overwrite").parquet(stored)
        folders = {(name, "parquet"): stored}
        for fmt in formats:
            if fmt != "parquet":
                folders[name, fmt] = f"{root}/{fmt}/{name}"
                writer = spark.read.parquet(stored).write.mode("overwrite")
                (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(folders[name, fmt])
        return folders

    written = side_by_side([partial(write, *entry) for entry in datasets.items()], at_once)
    return {key: folder for folders in written for key, folder in folders.items()}
