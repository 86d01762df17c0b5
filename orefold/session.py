"""Session settings, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Skewed join partitions are split even where that costs one more shuffle of the result: a hot order
# or product must never pin a third of the fact to one task.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def local_session(cpus: int | str = "*", app: str = "orefold", **conf: str) -> SparkSession:
    """Session for tests and the benchmark. A cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Turn on adaptive execution.

    The number of shuffle partitions is the session's, or a greater one by ``fit_shuffles``; small partitions are merged.
    """
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    return spark


# Bytes of stored input for which a shuffle gets a partition, and shuffled bytes up to which small ones are merged again.
# Lines come out of their files and shuffles many times as large, so both are far below what a task can hold.
INPUT_PER_PARTITION, MERGED_UP_TO = 8 << 20, 16 << 20
_FIRST = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_MERGED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def fit_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Let the first number of shuffle partitions grow with the input, so that what one task sorts or hashes does not.

    Never fewer partitions than the session or the cluster asks for, and none merged to a larger size than it allows; of a
    small input, adaptive execution merges them as before. Returns the number.
    """
    asked = int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.sparkContext.getConf().get(_FIRST, "0"))
    first = max(*asked, -(-input_bytes // INPUT_PER_PARTITION))
    spark.conf.set(_FIRST, str(first))
    merged = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_MERGED))
    if merged > MERGED_UP_TO:
        spark.conf.set(_MERGED, str(MERGED_UP_TO))
    return first


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_READ = "spark.sql.files.maxPartitionBytes"
READ_UP_TO = 16 << 20  # bytes of files for a task that deals out their rows: in memory they are some ten times as large


@contextmanager
def spared_disk(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of an execution go when it ends; otherwise they stay until the driver happens to collect
    its garbage. What is run again from the same DataFrame shuffles again. A task reads no more than it can deal out without
    spilling."""
    before = {key: spark.conf.get(key) for key in (_FREED, _READ)}
    spark.conf.set(_FREED, "true")
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before[_READ]) > READ_UP_TO:
        spark.conf.set(_READ, str(READ_UP_TO))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder below the shared checkpoint folder of the session."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="orefold-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/orefold/{label}-{uuid.uuid4().hex}"
