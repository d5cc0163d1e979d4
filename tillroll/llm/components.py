"""Connected components of links, by alternating large-star and small-star steps.

Every step is a minimum per node, combined before its shuffle, and a join that adaptive execution
splits where one node has a large share of the links. Links are written between rounds, so lost
executors cost at most a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.lookup import lookup_join
from tillroll.session import scratch_dir


def _written(links: DataFrame) -> DataFrame:
    path = scratch_dir(links.sparkSession, "links")
    links.write.parquet(path)
    return links.sparkSession.read.parquet(path)


def _state(links: DataFrame) -> tuple:
    """Tells one set of links from another: their number and two sums of hashes."""
    return tuple(
        links.agg(
            F.count(F.lit(1)),
            F.sum(F.shiftright(F.xxhash64("a", "b"), 20)),
            F.sum(F.shiftright(F.xxhash64("b", "a"), 20)),
        ).first()
    )


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour, or the node."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    larger = both.where(F.col("b") > F.col("a"))
    met = lookup_join(larger, least, {"a": "a"})
    return met.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Links go from larger to smaller; a node and its smaller neighbours get the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    met = lookup_join(links, least, {"a": "a"}).where(F.col("b") != F.col("least"))
    moved = met.select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.withColumnRenamed("least", "b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the least node reachable, of every node in ``links`` (a, b)."""
    apart = links.where(F.col("a") != F.col("b"))
    now = _written(
        apart.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = None
    while (state := _state(now)) != before:
        before = state
        if not state[0]:
            break
        now = _written(_small_star(_large_star(now)))
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.withColumn("component", F.col("node"))
    )
