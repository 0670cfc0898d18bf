"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.scratch import Shelf


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node move to the smallest of its neighbours and itself."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, move to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (u, v), the component being its smallest node.

    Alternating star contraction: the number of rounds grows with the logarithm
    of the longest path, and no round holds a component together.
    """
    shelf = Shelf(edges.sparkSession)
    links = shelf.put(edges.select("u", "v").where("u <> v").distinct(), "links")
    mark = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    before = None
    while True:
        links = shelf.put(_small_star(_large_star(links)).distinct(), "links")
        now = links.agg(F.count(F.lit(1)), mark).first()
        if now == before:
            break
        before = now
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(links.select("v", "v").distinct())
