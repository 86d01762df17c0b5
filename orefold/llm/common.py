"""What the operators of this subpackage share: session settings, stored intermediate tables, fold remainders."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orefold.session import ADAPTIVE, scratch_path

# A batch that crosses to Python holds a few megabytes of text whatever the length of the documents.
ARROW = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(2 << 20),
}

# Workers serve one stage after the other; these settings let them give the memory of large arrays back in between.
WORKERS = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_ARENA_MAX": "1",
    "MALLOC_MMAP_THRESHOLD_": str(1 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(8 << 20),
}


def prepare(spark: SparkSession) -> SparkSession:
    """Adaptive execution, bounded Arrow batches, and the package on the path of Python workers."""
    for key, value in {**ADAPTIVE, **ARROW}.items():
        spark.conf.set(key, value)
    home = str(Path(__file__).resolve().parent.parent.parent)
    environment = spark.sparkContext.environment
    for key, value in WORKERS.items():
        environment.setdefault(key, value)
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in known:
        environment["PYTHONPATH"] = os.pathsep.join([home, *filter(None, known)])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage with a table in the shared scratch folder, which outlives any executor."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_back(rows: DataFrame, groups: DataFrame, keys: list[str], label: str, how: str = "inner") -> DataFrame:
    """Join rows with an aggregate of themselves by its keys, safe for a key that holds a large part of the rows.

    The aggregate is stored first. Joined as it is, it would share the exchange of the rows and end in the middle of a stage,
    where adaptive execution splits nothing; read back, it is a side of its own, and the skewed partitions of the rows are
    split, or it is small enough, by its measured size, for Spark to broadcast it.
    """
    return rows.join(store(groups, label), keys, how)


def drop(*stored: DataFrame) -> None:
    """Delete tables made by ``store`` that nothing will read again."""
    for df in stored:
        spark = df.sparkSession
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def remainder(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the decimal doc_id modulo ``folds``; null for a null doc_id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % folds


def bounded_sample(rows: DataFrame, label: str, key: str, per_label: int) -> DataFrame:
    """The ``per_label`` rows of each label 0 and 1 whose key hashes lowest: at most twice ``per_label`` rows."""
    parts = [
        rows.filter(F.col(label) == value).orderBy(F.xxhash64(F.col(key)), F.col(key)).limit(per_label)
        for value in (0, 1)
    ]
    return parts[0].unionByName(parts[1])


def labelled(docs: DataFrame, labels: DataFrame, label: str, per_label: int, folds: int, held_out: int) -> DataFrame:
    """labelled_id, text, n_chars and ``label`` of a bounded sample of the labelled documents outside the held-out fold.

    The sample holds at most ``per_label`` ids of each label, so sending them to every task is bounded too. An id with both
    labels has label 0. Rows of equal id all come; whoever collects them keeps one of each, see ``one_per_id``.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("labelled_id"), F.col(label).cast("int").alias("label"))
    known = known.filter(remainder("labelled_id", folds) != held_out)
    picked = bounded_sample(known, "label", "labelled_id", per_label).groupBy("labelled_id").agg(F.min("label").alias("label"))
    size = F.col("n_chars") if "n_chars" in docs.columns else F.lit(None)
    body = docs.select("doc_id", F.col("text").cast("string").alias("text"), size.cast("long").alias("n_chars"))
    found = body.join(F.broadcast(picked), F.col("doc_id") == F.col("labelled_id"))
    return found.select("labelled_id", "text", "n_chars", "label")


def one_per_id(sample: DataFrame) -> DataFrame:
    """Of several rows of one ``id`` the least in its other columns, in their order: the same in every run."""
    others = [c for c in sample.columns if c != "id"]
    return sample.groupBy("id").agg(F.min(F.struct(*others)).alias("row")).select("id", "row.*")
