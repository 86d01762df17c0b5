"""Stored tables that change as a whole: every state in a folder of its own, the present one named by a pointer.

A new state is written completely, then put in place by the atomic creation of one empty file whose name holds a rising number
and the folder. Readers take the highest. A writer that stops at any step leaves the old state in place; there is no moment
without one, and nothing is renamed. The state before the present one stays until the next change, for readers that have
opened it; older ones are deleted. Two writers at once both succeed, and the higher name wins for every reader.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_POINTERS = "_pointers"


def file_system(spark: SparkSession, path: str):
    """Hadoop file system and path object."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = file_system(spark, path)
    return fs.exists(hadoop_path)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path, from their listing; 0 if there is none."""
    fs, hadoop_path = file_system(spark, path)
    return fs.getContentSummary(hadoop_path).getLength() if fs.exists(hadoop_path) else 0


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, ascending; none if there is no folder."""
    fs, hadoop_path = file_system(spark, path)
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path)) if fs.exists(hadoop_path) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = file_system(spark, path)
    fs.delete(hadoop_path, True)


def create(spark: SparkSession, path: str) -> None:
    """An empty file, atomically; an error if it exists."""
    fs, hadoop_path = file_system(spark, path)
    fs.create(hadoop_path, False).close()


def pointers(spark: SparkSession, path: str) -> list[str]:
    return names(spark, f"{path.rstrip('/')}/{_POINTERS}")


def new_version(path: str) -> str:
    """Folder for the next state, unknown to readers until ``commit``."""
    return f"{path.rstrip('/')}/v-{uuid4().hex}"


def commit(spark: SparkSession, path: str, version: str) -> None:
    """Make a written folder the state of the table."""
    path, known = path.rstrip("/"), pointers(spark, path)
    number = int(known[-1].partition("-")[0]) + 1 if known else 1
    create(spark, f"{path}/{_POINTERS}/{number:012d}-{version.rpartition('/')[2]}")
    for old in known[:-1]:
        delete(spark, f"{path}/{_POINTERS}/{old}")
        delete(spark, f"{path}/{old.partition('-')[2]}")


def current(spark: SparkSession, path: str) -> str:
    """Folder of the present state; the path itself for a table that was stored without versions."""
    known = pointers(spark, path)
    return f"{path.rstrip('/')}/{known[-1].partition('-')[2]}" if known else path


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(current(spark, path))
