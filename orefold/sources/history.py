"""States of a keyed table over time: a base, then the changed keys of every later snapshot.

A snapshot stores only rows that differ from the state before and the keys that are gone, so what n snapshots take follows
the changes and not the table. A read merges: of every key the latest entry up to the moment counts, one aggregate that is
combined before its shuffle. Folders of entries are listed in a log of empty files, created atomically after the entries are
written; a snapshot that failed half-way is in no log entry and is never read. Expiry rolls the oldest kept state forward into
a new base before it deletes what only older moments need.

Keys must be unique in every state; a null in a key is a value like any other. All states have the columns of the first.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orefold import schemas
from orefold.sources import versions

FORMAT = "%Y%m%d%H%M%S"
_LOG = "_log"
_BASE, _CHANGES = "base", "changes"
_STAMP, _GONE, _ROW = "_STAMP", "_GONE", "_ROW"


def stamp(moment: datetime) -> int:
    return int(moment.strftime(FORMAT))


def _entries(spark: SparkSession, path: str) -> list[tuple[int, str, str]]:
    """(stamp, kind, folder) of every entry of the log, by stamp; a base comes before changes of the same stamp."""
    found = [name.split("-", 2) for name in versions.names(spark, f"{path}/{_LOG}")]
    return sorted((int(at), kind, f"{path}/{kind}-{at}-{own}") for at, kind, own in found)


def _add(spark: SparkSession, path: str, at: int, kind: str, df: DataFrame) -> None:
    own = uuid4().hex
    df.write.parquet(f"{path}/{kind}-{at}-{own}")
    versions.create(spark, f"{path}/{_LOG}/{at}-{kind}-{own}")


def snapshots(spark: SparkSession, path: str) -> list[int]:
    """Stamps of the snapshots that can be read, ascending."""
    return sorted({at for at, _, _ in _entries(spark, path)})


def _needed(spark: SparkSession, path: str, at: int) -> list[tuple[int, str, str]]:
    """The latest base up to ``at`` and the changes behind it."""
    upto = [entry for entry in _entries(spark, path) if entry[0] <= at]
    bases = [entry for entry in upto if entry[1] == _BASE]
    if not bases:
        raise ValueError(f"no snapshot of {path} at or before {at}")
    return [bases[-1], *[entry for entry in upto if entry[1] == _CHANGES and entry[0] > bases[-1][0]]]


def _state(spark: SparkSession, path: str, keys: Sequence[str], at: int) -> DataFrame:
    (_, _, base), *changes = _needed(spark, path, at)
    rows = spark.read.parquet(base)
    if not changes:
        return rows
    columns = rows.columns
    entries = rows.select(*columns, F.lit(False).alias(_GONE), F.lit(0).cast("bigint").alias(_STAMP))
    for taken, _, folder in changes:
        entries = entries.unionByName(spark.read.parquet(folder).withColumn(_STAMP, F.lit(taken).cast("bigint")))
    others = [c for c in columns if c not in keys]
    latest = entries.groupBy(*keys).agg(F.max_by(F.struct(_GONE, *others), _STAMP).alias(_ROW))
    return latest.filter(~F.col(_ROW)[_GONE]).select(*[c if c in keys else F.col(_ROW)[c].alias(c) for c in columns])


def write_snapshot(df: DataFrame, path: str, keys: Sequence[str], taken: datetime) -> None:
    """Add the state of a table at ``taken``, later than all before: the first as a base, others as changes to the last."""
    spark, at = df.sparkSession, stamp(taken)
    known = snapshots(spark, path)
    if known and at <= known[-1]:
        raise ValueError(f"{path} already has a snapshot of {known[-1]}")
    if not known:
        _add(spark, path, at, _BASE, df)
        return
    before = _state(spark, path, keys, known[-1])
    columns, others = before.columns, [c for c in before.columns if c not in keys]
    sides = before.select(*columns, F.lit(0).alias("_NEW")).unionByName(df.select(*columns, F.lit(1).alias("_NEW")))
    # One aggregate per key instead of an outer join: both sides of a key meet, and equal ones are dropped.
    row = F.struct(*others) if others else F.lit(0)
    met = sides.groupBy(*keys).agg(
        F.max(F.when(F.col("_NEW") == 0, F.struct(row.alias("r")))).alias("old"),
        F.max(F.when(F.col("_NEW") == 1, F.struct(row.alias("r")))).alias("new"),
    )
    changed = met.filter(~F.col("old").eqNullSafe(F.col("new")))
    entries = changed.select(
        *[c if c in keys else F.col("new")["r"][c].alias(c) for c in columns], F.col("new").isNull().alias(_GONE)
    )
    _add(spark, path, at, _CHANGES, entries)


def read_as_of(spark: SparkSession, path: str, keys: Sequence[str], moment: datetime) -> DataFrame:
    """The table as it was at ``moment``; only the base and the changes up to then are read."""
    return _state(spark, path, keys, stamp(moment))


def restore(spark: SparkSession, path: str, keys: Sequence[str], moment: datetime, now: datetime) -> None:
    """Make the state of ``moment`` the newest one, as a further snapshot; nothing is lost."""
    write_snapshot(read_as_of(spark, path, keys, moment), path, keys, now)


def expire(spark: SparkSession, path: str, keys: Sequence[str], layer: str, now: datetime) -> int:
    """Delete what no moment within the retention of the layer needs; returns the deleted folders.

    The state at the oldest kept moment becomes a base first, at its own stamp, so every kept moment reads as before. The log
    entry of a folder goes before the folder; stopped at any step, what is left is complete.
    """
    oldest = stamp(now - timedelta(days=schemas.RETENTION_DAYS[layer]))
    upto = [entry for entry in _entries(spark, path) if entry[0] <= oldest]
    if not upto:
        return 0
    rolled = upto[-1][0]
    if not any(kind == _BASE and at == rolled for at, kind, _ in upto):
        _add(spark, path, rolled, _BASE, _state(spark, path, keys, rolled))
    kept = [entry for entry in _entries(spark, path) if entry[0] == rolled and entry[1] == _BASE][-1]
    doomed = [entry for entry in _entries(spark, path) if entry[0] <= rolled and entry != kept]
    # Bases go before changes: from then on an expired moment is an error, never a state with changes missing.
    for at, kind, folder in sorted(doomed, key=lambda entry: (entry[1] == _CHANGES, -entry[0])):
        versions.delete(spark, f"{path}/{_LOG}/{at}-{kind}-{folder.rpartition('-')[2]}")
        versions.delete(spark, folder)
    return len(doomed)
