"""Connected components of an edge table, by alternating stars, all in joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.files import settled


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(key, root) of every node of the edges (a, b): the least node of its component; loops name single nodes.

    Each round links every node's larger neighbours, then all its neighbours, to the least one around, and writes the
    edges; it ends when a round changes nothing, after a number of rounds that grows with the logarithm of the nodes.
    """
    nodes = edges.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    now = settled(edges.where("a != b").distinct(), "edges")
    mark = None
    while True:
        both = _both_ways(now)
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a != b")
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        lowest = down.groupBy("a").agg(F.min("b").alias("least"))
        small = down.join(lowest, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a != b")
        now = settled(small.unionByName(lowest.select("a", F.col("least").alias("b"))).distinct(), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % F.lit(1 << 40))).first()
        if state == mark:
            break
        mark = state
    roots = now.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "key")
    return nodes.join(roots, "key", "left").select("key", F.coalesce("root", "key").alias("root"))
