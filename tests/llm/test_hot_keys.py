"""Joins of rows with an aggregate of themselves split a key that holds half of the rows."""

import pytest
from pyspark.sql import functions as F

from orefold.llm import components, warc
from orefold.llm.common import join_back, prepare


@pytest.fixture
def skewed(spark):
    """Thresholds so low that a few thousand rows count as skewed, and no broadcasts."""
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in low}
    prepare(spark)
    for key, value in low.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def rows(spark, n=40_000):
    return spark.range(n, numPartitions=8).selectExpr("if(id % 2 = 0, -1, id) AS u", "xxhash64(id) AS v")


def test_an_aggregate_joined_back_is_split(skewed):
    table = rows(skewed)
    groups = table.groupBy("u").agg(F.min("v").alias("least"))
    assert "skew=true" not in executed(table.join(groups, "u"))  # why the aggregate is stored
    assert "skew=true" in executed(join_back(table, groups, ["u"], "test"))


def test_stars_split_a_hot_centre(skewed):
    edges = skewed.range(1, 20_001, numPartitions=8).selectExpr("id AS u", "if(id % 2 = 0, 0, id - 1) AS v")
    joined = components.large_star(edges)
    assert "skew=true" in executed(joined)


def test_a_payload_that_half_of_the_pages_share(skewed):
    pages = skewed.range(20_000, numPartitions=8).selectExpr(
        "id AS page_id", "'u' AS url", "if(id % 2 = 0, repeat('same ', 20), string(xxhash64(id))) AS html"
    )
    found = warc.resolved(pages)
    plan = executed(found)
    assert "hashpartitioning(digest" not in plan and "hashpartitioning(its_digest" not in plan
    by_page = {r["page_id"]: r["refers_to"] for r in found.select("page_id", "refers_to").collect()}
    assert len(by_page) == 20_000 and all(by_page[i] == (0 if i and i % 2 == 0 else None) for i in by_page)


def test_a_folder_without_scheme_is_that_of_the_default_file_system(spark):
    assert warc.qualified(spark, "/tmp/x").startswith("file:")
