"""Connected components by alternating large-star and small-star rounds.

An edge set is kept as (u, v) with u > v. A large-star round links every larger neighbour of a node to the node's smallest
neighbour (or itself); a small-star round links the smaller neighbours of a node, and the node, to the smallest of them. Rounds
alternate until the edges do not change; they are then one star per component, with the smallest id at its centre.

A round is an aggregate (the smallest neighbour per node, combined before the shuffle), stored and joined back to the edges, so
a node with very many neighbours is a skewed join partition, which adaptive execution splits, and never one group in one
task. Each round is stored in the shared scratch folder and the edges before are deleted. Only the number of edges and a hash
sum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orefold.llm.common import drop, join_back, store


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("digest")).first()
    return row["n"], int(row["digest"] or 0)


def _ordered(pairs: DataFrame) -> DataFrame:
    return (
        pairs.filter(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _ordered(join_back(both, least, ["u"], "least").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")))


def small_star(edges: DataFrame) -> DataFrame:
    least = store(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    linked = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _ordered(linked.unionByName(least.select("u", F.col("m").alias("v"))))


def components(pairs: DataFrame, one: str, other: str) -> DataFrame:
    """(node, component) for every node of an edge but the smallest of its component; a stored table.

    Null ends and self-links are ignored, repeated and reversed pairs count once; without pairs the result is empty.
    """
    named = pairs.select(F.col(one).cast("bigint").alias("u"), F.col(other).cast("bigint").alias("v")).dropna()
    edges = store(_ordered(named), "edges")
    state = _state(edges)
    while state[0]:
        before = state
        for star in (large_star, small_star):
            following = store(star(edges), "edges")
            drop(edges)
            edges = following
        state = _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
