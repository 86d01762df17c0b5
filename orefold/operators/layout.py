"""Stored order of files, lookups that profit from it, and log tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orefold.session import scratch_path

_SLICE, _CURVE, _RANGE, _RANK = "_SLICE", "_CURVE", "_RANGE", "_RANK"
SAMPLE_ROWS = 10_000  # rows of the keys that reach the driver to find their ranks
RANK_BITS = 5
COMPRESSION = "zstd"


def as_is(rows: DataFrame) -> DataFrame:
    return rows


def key_ranks(df: DataFrame, keys: Sequence[str], bits: int = RANK_BITS, sample_rows: int = SAMPLE_ROWS) -> list[Column]:
    """A rank from 0 to 2^bits - 1 for every key: how many of its quantiles in a bounded sample are not above the value.

    Any type that sorts has ranks; null has the lowest. A value that holds many rows is one quantile, not several.
    """
    sample = df.select(*keys).orderBy(F.rand(7)).limit(sample_rows).collect()
    ranks = []
    for key in keys:
        values = sorted(row[key] for row in sample if row[key] is not None)
        picked = {values[len(values) * i // (1 << bits)] for i in range(1, 1 << bits)} if values else set()
        kind = df.schema[key].dataType
        ranks.append(_rank(F.col(key), [F.lit(bound).cast(kind) for bound in sorted(picked)]))
    return ranks


def _rank(value: Column, bounds: Sequence[Column], below: int = 0) -> Column:
    """How many of the ascending bounds are not above the value, ``below`` more; found by halving, so a row is compared with
    few of them. A null is above none."""
    if not bounds:
        return F.lit(below)
    middle = len(bounds) // 2
    upper, lower = _rank(value, bounds[middle + 1 :], below + middle + 1), _rank(value, bounds[:middle], below)
    return F.when(value >= bounds[middle], upper).otherwise(lower)


def curve(ranks: Sequence[Column], bits: int = RANK_BITS) -> Column:
    """Place on the Z-order curve: the bits of all ranks in turns, the first rank's bit before the second's."""
    place = F.lit(0).cast("bigint")
    for bit in reversed(range(bits)):
        for number, rank in enumerate(ranks):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("bigint")
            place = place + F.shiftleft(one, bit * len(ranks) + len(ranks) - 1 - number)
    return place


def clustered_write(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    files: int | None = None,
    lookup_columns: Sequence[str] = (),
    curved: bool = False,
    completed: Callable[[DataFrame], DataFrame] = as_is,
) -> None:
    """Write ``df`` so that each file covers a narrow range of ``keys``.

    In the order of the keys a file is narrow in the first only; ``curved`` deals rows out along a space-filling curve over
    the ranks of the keys, so that a filter on any of them skips files. The input partition is the last range column: rows
    that share all keys, even a large part of the table, are still spread over several files. ``lookup_columns`` get a
    bloom filter for equality lookups. ``completed`` adds columns that follow from others of a row once the rows lie in their
    order, so that they are not shuffled.
    """
    sliced = df.withColumn(_SLICE, F.spark_partition_id())
    bounds = [*keys, _SLICE]
    if curved:
        # Ranks are columns of their own: the curve takes each rank once for every bit.
        ranks = {f"{_RANK}{i}": rank for i, rank in enumerate(key_ranks(df, keys))}
        place = curve([F.col(name) for name in ranks])
        sliced, bounds = sliced.withColumns(ranks).withColumn(_CURVE, place).drop(*ranks), [_CURVE, *bounds]
    ranged = sliced.repartitionByRange(files, *bounds) if files else sliced.repartitionByRange(*bounds)
    ordered = completed(ranged.sortWithinPartitions(*keys).drop(_SLICE, _CURVE))
    writer = ordered.write.mode("overwrite").option("compression", COMPRESSION)
    for column in lookup_columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(path)


def running_totals(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``df`` with the running sums of ``columns`` in the order of ``key`` (unique), in two levels.

    Rows are dealt out by range and stored; a window runs within each range, and the sums of the ranges before it, one row
    per range, are carried in. No task sees all rows.
    """
    ranged = df.repartitionByRange(key).withColumn(_RANGE, F.spark_partition_id())
    stored = scratch_path(df.sparkSession, "ranges")
    ranged.write.parquet(stored)
    ranged = df.sparkSession.read.schema(ranged.schema).parquet(stored)
    earlier = W.orderBy(_RANGE).rowsBetween(W.unboundedPreceding, -1)
    sums = ranged.groupBy(_RANGE).agg(*[F.sum(c).alias(c) for c in columns])
    carried = sums.select(_RANGE, *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_BEFORE_{c}") for c in columns])
    within = W.partitionBy(_RANGE).orderBy(key).rowsBetween(W.unboundedPreceding, W.currentRow)
    others = [c for c in df.columns if c not in columns]
    return ranged.join(carried, _RANGE).select(
        *others, *[(F.sum(c).over(within) + F.col(f"_BEFORE_{c}")).alias(c) for c in columns]
    )


def clustering_report(table: DataFrame, key: str) -> DataFrame:
    """Key range of each file and how many other files overlap it.

    A file misses another if it ends before the other starts. Both counts come from running totals over the distinct
    bounds, not from comparing files with each other; files are counted per bound before the totals.
    """
    ranges = (
        table.groupBy(F.col("_metadata.file_path").alias("FILE_PATH"))
        .agg(F.min(key).alias("MIN_KEY"), F.max(key).alias("MAX_KEY"), F.count(F.lit(1)).alias("ROW_COUNT"))
        .filter(F.col("MIN_KEY").isNotNull())
    )
    starts = F.struct(F.col("MIN_KEY").alias("AT"), F.lit(1).alias("KIND"))
    ends = F.struct(F.col("MAX_KEY").alias("AT"), F.lit(2).alias("KIND"))
    edges = ranges.select("*", F.explode(F.array(starts, ends)).alias("EDGE")).select("*", "EDGE.*").drop("EDGE")
    at_bound = edges.groupBy("AT").agg(
        F.count_if(F.col("KIND") == 1).alias("STARTED"), F.count_if(F.col("KIND") == 2).alias("ENDED")
    )
    totals = running_totals(at_bound.withColumn("ENDING", F.col("ENDED")), "AT", ("STARTED", "ENDED")).select(
        "AT", "STARTED", (F.col("ENDED") - F.col("ENDING")).alias("ENDED_BEFORE")
    )
    counted = edges.join(totals, "AT")
    return counted.groupBy("FILE_PATH", "MIN_KEY", "MAX_KEY", "ROW_COUNT").agg(
        (
            F.max(F.when(F.col("KIND") == 2, F.col("STARTED")))
            - F.max(F.when(F.col("KIND") == 1, F.col("ENDED_BEFORE")))
            - 1
        ).alias("OVERLAPS")
    )


def clustering_depth(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """For each key: files, the mean and the greatest number of other files that a file overlaps."""
    return reduce(
        DataFrame.unionByName,
        [
            clustering_report(table, key).agg(
                F.lit(key).alias("KEY"),
                F.count(F.lit(1)).alias("FILES"),
                F.avg("OVERLAPS").alias("MEAN_OVERLAPS"),
                F.max("OVERLAPS").alias("MAX_OVERLAPS"),
            )
            for key in keys
        ],
    )


def point_lookup(table: DataFrame, column: str, value) -> DataFrame:
    """Equality on one column; the filter reaches the file scan."""
    return table.filter(F.col(column) == F.lit(value))


def _since(log: DataFrame, as_of: Column | None) -> Column:
    return log.agg(F.max("START_TIME")).scalar() if as_of is None else as_of


def top_expensive_queries(log: DataFrame, as_of: Column | None = None, days: int = 7, n: int = 10) -> DataFrame:
    """Slowest successful entries of the last days; without ``as_of`` the newest entry is the present."""
    recent = F.col("START_TIME") >= _since(log, as_of) - F.make_dt_interval(F.lit(days))
    return (
        log.filter(recent & (F.col("EXECUTION_STATUS") == "SUCCESS"))
        .orderBy(F.col("TOTAL_ELAPSED_TIME").desc_nulls_first(), "QUERY_ID")
        .limit(n)
        .select(
            "QUERY_ID",
            F.left("QUERY_TEXT", F.lit(80)).alias("QUERY_SNIPPET"),
            (F.col("TOTAL_ELAPSED_TIME") / 1000).alias("ELAPSED_SEC"),
            (F.col("BYTES_SCANNED") / 1e9).alias("GB_SCANNED"),
            "CREDITS_USED_CLOUD_SERVICES",
            "WAREHOUSE_NAME",
            "START_TIME",
        )
    )


def usage_by_group(log: DataFrame, as_of: Column | None = None, months: int = 1) -> DataFrame:
    """Credits per warehouse over the last months, largest first."""
    recent = F.col("START_TIME") >= _since(log, as_of) - F.make_ym_interval(F.lit(0), F.lit(months))
    return (
        log.filter(recent)
        .groupBy("WAREHOUSE_NAME")
        .agg(
            F.sum("CREDITS_USED").alias("TOTAL_CREDITS"),
            F.sum("CREDITS_USED_COMPUTE").alias("COMPUTE_CREDITS"),
        )
        .orderBy(F.col("TOTAL_CREDITS").desc_nulls_first(), "WAREHOUSE_NAME")
    )
