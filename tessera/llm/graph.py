"""Connected components of a graph given as links, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import discard, persisted


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are hung on the least of it and its neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are hung on the least of those."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b")
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).filter("a > b")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links(a, b); root is the smallest node
    reachable.  Links may repeat, run either way and join a node to itself.

    Both star operations are joins of links with one aggregated row a node, so
    a hub never gathers its neighbours in one task.  A round's links are
    written to the shared folder; those of the round before are deleted.
    """
    spark = links.sparkSession
    now = persisted(links.filter("a <> b").select("a", "b").distinct(), "links")
    while True:
        then = now
        large = persisted(_large_star(then).distinct(), "links")
        now = persisted(_small_star(large).distinct(), "links")
        # a star forest is a fixed point: every node has one link, to a root that has none upwards
        state = [d.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
                 for d in (then, now)]
        discard(spark, large)
        discard(spark, then)
        if state[0] == state[1]:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
