"""Column profiles, duplicate and reference checks of raw tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orefold.functions import numbers, text

# What counts as a number in a source file: sign, digits with single underscores between them, a fraction,
# an exponent, or a spelled-out infinity or not-a-number (fixed grammar).
_DIGITS = r"\d(_?\d)*"
NUMBER_PATTERN = (
    rf"(?i)^[+-]?(inf(inity)?|nan|({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})(e[+-]?{_DIGITS})?)$"
)


def _per_column(df: DataFrame, measures: dict[str, callable]) -> DataFrame:
    """One pass over the table, then one row per column: COLUMN_NAME, TOTAL_ROWS and the measures."""
    counted = df.agg(
        F.count(F.lit(1)).alias("TOTAL_ROWS"),
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("COLUMN_NAME"),
                    *[measure(F.col(f"`{name}`")).alias(label) for label, measure in measures.items()],
                )
                for name in df.columns
            ]
        ).alias("COLUMNS"),
    )
    return counted.select("TOTAL_ROWS", F.inline("COLUMNS"))


def _blank_count(column: Column) -> Column:
    return F.count_if(text.is_blank(column))


def _all_numbers(column: Column) -> Column:
    return F.coalesce(
        F.bool_and(text.is_blank(column) | F.regexp_replace(column.cast("string"), r"(?U)^\s+|\s+$", "").rlike(NUMBER_PATTERN)), F.lit(True)
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Blank values per column; an empty or all-space text is blank."""
    share = F.when(F.col("TOTAL_ROWS") == 0, F.lit(0).cast("decimal(28,2)")).otherwise(
        numbers.percent(F.col("NULL_COUNT"), F.col("TOTAL_ROWS"))
    )
    return _per_column(df, {"NULL_COUNT": _blank_count}).withColumn("NULL_PCT", share)


def numeric_hint(df: DataFrame) -> DataFrame:
    """Whether every non-blank value of a column reads as a number; true for an all-blank column."""
    return _per_column(df, {"IS_NUMERIC": _all_numbers}).drop("TOTAL_ROWS")


def sample(df: DataFrame, order_by: Sequence[str], n: int = 3) -> DataFrame:
    return df.orderBy(*order_by).limit(n)


def summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, column count and whether anything is blank, one row per table."""

    def one(name: str, df: DataFrame) -> DataFrame:
        blank = reduce(Column.__or__, [text.is_blank(F.col(f"`{c}`")) for c in df.columns])
        return df.agg(
            F.lit(name).alias("FILE_NAME"),
            F.count(F.lit(1)).alias("TOTAL_ROWS"),
            F.lit(len(df.columns)).cast("long").alias("COLUMN_COUNT"),
            F.coalesce(F.bool_or(blank), F.lit(False)).alias("HAS_NULLS"),
        )

    return reduce(DataFrame.unionByName, [one(name, df) for name, df in tables.items()])


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and column list, one row per table."""

    def one(name: str, df: DataFrame) -> DataFrame:
        return df.agg(
            F.lit(name).alias("TABLE_NAME"),
            F.count(F.lit(1)).alias("ROW_COUNT"),
            F.lit(",".join(df.columns)).alias("COLUMN_LIST"),
        )

    return reduce(DataFrame.unionByName, [one(name, df) for name, df in tables.items()])


def duplicate_groups(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """Number of key combinations that occur more than once; null for a table without a declared key."""

    def one(name: str, df: DataFrame) -> DataFrame:
        label = F.lit(name).alias("TABLE_NAME")
        if name not in keys:
            return df.limit(0).agg(label, F.lit(None).cast("long").alias("DUPLICATE_GROUPS"))
        repeated = df.groupBy(*keys[name]).agg(F.count(F.lit(1)).alias("COPIES"))
        return repeated.agg(label, F.count_if(F.col("COPIES") > 1).alias("DUPLICATE_GROUPS"))

    return reduce(DataFrame.unionByName, [one(name, df) for name, df in tables.items()])


def _labelled(keys: Mapping[str, Column]) -> Column:
    """One row per label: LABEL, KEY."""
    return F.inline(
        F.array(*[F.struct(F.lit(label).alias("LABEL"), key.cast("string").alias("KEY")) for label, key in keys.items()])
    )


def unmatched_rows(
    children: Sequence[tuple[DataFrame, Mapping[str, Column]]], parents: Sequence[tuple[DataFrame, Mapping[str, Column]]]
) -> DataFrame:
    """Rows whose key under a label is null or not among the parents' keys under that label: LABEL, ORPHAN_ROWS.

    Each table is read once for all its labels. Rows are counted per label and key before the join, so a key that
    repeats often costs no more than any other.
    """
    labels = [label for _, keys in children for label in keys]
    counts = reduce(
        DataFrame.unionByName,
        [df.select(_labelled(keys)).groupBy("LABEL", "KEY").agg(F.count(F.lit(1)).alias("COPIES")) for df, keys in children],
    )
    known = reduce(DataFrame.unionByName, [df.select(_labelled(keys)) for df, keys in parents])
    per_label = F.array(
        *[
            F.struct(
                F.lit(label).alias("LABEL"),
                F.coalesce(F.sum(F.when(F.col("LABEL") == label, F.col("COPIES"))), F.lit(0)).alias("ORPHAN_ROWS"),
            )
            for label in labels
        ]
    )
    missing = counts.join(known, ["LABEL", "KEY"], "left_anti")
    return missing.agg(per_label.alias("FOUND")).select(F.inline("FOUND"))


def foreign_key_report(tables: Mapping[str, DataFrame], edges: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Unmatched rows per declared reference between tables; each table is read once as child and once as parent."""
    children: dict[str, dict[str, Column]] = {}
    parents: dict[str, dict[str, Column]] = {}
    for child, child_key, parent, parent_key in edges:
        edge = f"{child}.{child_key} -> {parent}.{parent_key}"
        children.setdefault(child, {})[edge] = F.col(child_key)
        parents.setdefault(parent, {})[edge] = F.col(parent_key)
    found = unmatched_rows(
        [(tables[name], keys) for name, keys in children.items()], [(tables[name], keys) for name, keys in parents.items()]
    )
    return found.withColumnRenamed("LABEL", "EDGE")


def reconcile(sources: Mapping[str, DataFrame], loaded: Mapping[str, DataFrame]) -> DataFrame:
    """Source rows against loaded rows per table; a table on one side only shows null on the other."""

    def counts(tables: Mapping[str, DataFrame], label: str) -> DataFrame:
        return reduce(
            DataFrame.unionByName,
            [df.agg(F.lit(name).alias("TABLE_NAME"), F.count(F.lit(1)).alias(label)) for name, df in tables.items()],
        )

    return (
        counts(sources, "SOURCE_ROWS")
        .join(counts(loaded, "LOADED_ROWS"), "TABLE_NAME", "full")
        .withColumn("DIFFERENCE", F.col("LOADED_ROWS") - F.col("SOURCE_ROWS"))
    )
