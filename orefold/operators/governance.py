"""Masked and row-filtered tables per role, and the inventory of personal data.

Role, user and the tiers of the roles are parameters. First name, last name and age stay readable under every role, and only the sales
fact has a row filter: that is what the policies cover.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orefold import schemas
from orefold.functions import masks
from orefold.operators.profiling import null_profile

POLICIES = {
    "EMAIL_ADDRESS": masks.mask_email,
    "FULL_NAME": masks.mask_full_name,
    "ANNUAL_INCOME": masks.mask_income,
    "BIRTH_DATE": masks.mask_birth_date,
}

ACCESS_DDL = "USER_NAME string not null, TERRITORY_KEY long not null"

# Example mapping rows (fixed values).
DEFAULT_ACCESS = (("VIEWER_USER", 1), ("VIEWER_USER", 2), ("VIEWER_USER", 3))


def masked_customers(dim_customer: DataFrame, role: str, tiers: Mapping[str, str] = masks.ROLE_TIERS) -> DataFrame:
    """The customer dimension as ``role`` sees it; later grouping and filtering see the masked values."""
    return dim_customer.withColumns({c: policy(F.col(c), role, tiers) for c, policy in POLICIES.items()})


def masked_silver_customers(customers: DataFrame, role: str, tiers: Mapping[str, str] = masks.ROLE_TIERS) -> DataFrame:
    """Below the star only the email is masked."""
    return customers.withColumn("EMAIL_ADDRESS", masks.mask_email(F.col("EMAIL_ADDRESS"), role, tiers))


def access_table(spark: SparkSession, rows=DEFAULT_ACCESS) -> DataFrame:
    return spark.createDataFrame(list(rows), ACCESS_DDL)


def visible_sales(
    fact_sales: DataFrame, access: DataFrame, role: str, user: str, tiers: Mapping[str, str] = masks.ROLE_TIERS
) -> DataFrame:
    """Privileged roles and analysts see all rows, others only the territories mapped to ``user``."""
    if masks.tier_of(role, tiers) != masks.OTHER:
        return fact_sales
    allowed = access.filter(F.col("USER_NAME") == user).select("TERRITORY_KEY")
    return fact_sales.join(allowed, "TERRITORY_KEY", "left_semi")


def _by_column(labels: Mapping[str, tuple], names: Sequence[str]) -> Column:
    """Struct of labels for COLUMN_NAME."""
    fields = ", ".join(f"{name}:string" for name in names)
    found = F.lit(None).cast(f"struct<{fields}>")
    for column, values in labels.items():
        label = F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(names, values)])
        found = F.when(F.col("COLUMN_NAME") == column, label).otherwise(found)
    return found


def _labelled_columns(name: str, df: DataFrame, labels: Mapping[str, tuple], names: Sequence[str]) -> DataFrame:
    """The labelled columns of one table with the number of filled rows, in one pass over them."""
    return (
        null_profile(df.select(*labels))
        .select(
            F.lit(name).alias("TABLE_NAME"),
            "COLUMN_NAME",
            _by_column(labels, names).alias("LABELS"),
            (F.col("TOTAL_ROWS") - F.col("NULL_COUNT")).alias("FILLED_ROWS"),
        )
        .select("TABLE_NAME", "COLUMN_NAME", "LABELS.*", "FILLED_ROWS")
    )


def pii_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Columns with personal data in the given tables, their category, policy, class and how many values are filled."""
    _, action, _ = schemas.SENSITIVITY["RESTRICTED"]
    names = ("PII_CATEGORY", "POLICY", "SENSITIVITY", "REQUIRED_ACTION")
    parts = []
    for name, df in tables.items():
        labels = {
            column: (category, policy, "RESTRICTED", action)
            for table, column, category, policy in schemas.PII_COLUMNS
            if table == name
        }
        parts.append(_labelled_columns(name, df, labels, names))
    return reduce(DataFrame.unionByName, parts)


def sensitivity_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Classified columns of the given tables, what their class requires and how many values are filled."""
    parts = []
    for name, df in tables.items():
        labels = {
            column: (level, action)
            for level, (_, action, listed) in schemas.SENSITIVITY.items()
            for column in listed.get(name, ())
        }
        if labels:
            parts.append(_labelled_columns(name, df, labels, ("SENSITIVITY", "REQUIRED_ACTION")))
    return reduce(DataFrame.unionByName, parts)
