"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorastat.llm.common import materialize


def _size(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; the component is its least node.

    Each round points every node first to the least node around it and then joins the
    nodes that share a neighbour; components halve in depth, so rounds grow with the
    logarithm of the longest chain. Rounds are written to the shared folder. Links are
    combined before they are shuffled; the join on a frequent centre is a plain join
    that adaptive execution splits.
    """
    edges = materialize(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while (now := _size(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large, "links")  # a > b in every row
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        stars = small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
        edges = materialize(stars.distinct(), "links")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
