"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivertally.session import durable


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    around = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = around.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them. Here a > b in every link."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a > b").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root`` (smallest node it can reach) for every node that is not its own root.

    Rounds of large-star and small-star keep at most one row per link, need no node's neighbours together
    in memory, and end after some log-squared rounds. Each round is a written table, so a lost executor
    costs one round. Links in either direction, repeated links, loops and no links at all are fine; links with a
    missing end are none.
    """
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    edges = durable(links.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b"), (x.isNull() | y.isNull()).alias("no")).where("not no and a > b").select("a", "b").distinct())
    before = _state(edges)
    while before[0]:
        edges = durable(_small_star(_large_star(edges)))
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
