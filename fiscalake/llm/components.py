"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalake.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    # a sum of hashes in decimals: equal sets of edges give equal sums
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("x", "y").cast("decimal(20,0)")).alias("sum"),
        F.sum(F.xxhash64("y", "x").cast("decimal(20,0)")).alias("other"),
    ).first()
    return row["n"], row["sum"], row["other"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked with the least of the node and its neighbours."""
    both = edges.union(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
    least = both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("least"))
    # the least neighbours are stored so that a hub's links are split by the join
    return (
        both.where(F.col("y") > F.col("x"))
        .join(stored(least, "large-star"), "x")
        .select(F.col("y").alias("x"), F.col("least").alias("y"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its lower neighbours are linked with the least of these."""
    least = stored(edges.groupBy("x").agg(F.min("y").alias("least")), "small-star")
    lower = edges.join(least, "x").where(F.col("y") != F.col("least"))
    return (
        lower.select(F.col("y").alias("x"), F.col("least").alias("y"))
        .union(least.select("x", F.col("least").alias("y")))
        .distinct()
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) of every end of ``edges`` (x, y); a component's name is its least id.

    Loops and repeated or reversed edges are allowed. Each round is stored, so lineage
    does not grow and nothing is lost with an executor.
    """
    oriented = edges.where(F.col("x") != F.col("y")).select(
        F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")
    )
    current = stored(oriented.distinct(), "edges")
    state = _state(current)
    while state[0]:
        current = stored(_small_star(_large_star(current)), "edges")
        before, state = state, _state(current)
        if state == before:
            break
    centres = current.select(F.col("y").alias("id"), F.col("y").alias("component")).distinct()
    return current.select(F.col("x").alias("id"), F.col("y").alias("component")).union(centres)
