"""Connected components by alternating stars, each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel.session import materialise, temporary_tables


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); root is the smallest reachable node.

    A large star links a node's larger neighbours to the smallest node it knows, a small
    star its smaller neighbours; both keep components whole, and the number of rounds grows
    with the logarithm of a component's size. Minima are aggregates joined back, so a node
    with very many neighbours is never gathered in one task.
    """
    links = materialise(_ordered(edges.select("a", "b")), "links")
    seen = None
    while True:
        mark = links.agg(
            F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)).alias("x")
        ).first()
        if seen == tuple(mark):
            break
        seen = tuple(mark)
        with temporary_tables(links.sparkSession) as keep:
            both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
            least = materialise(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), "star-minima")
            large = both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("m").alias("a"), "b")
            large = materialise(_ordered(large), "large-star")
            # every link now runs from a smaller a to a larger b
            lowest = materialise(large.groupBy("b").agg(F.min("a").alias("m")), "star-minima")
            joined = large.join(lowest, "b")
            small = joined.select(F.col("m").alias("a"), F.col("a").alias("b")).unionByName(
                lowest.select(F.col("m").alias("a"), "b")
            )
            links = keep(_ordered(small), "small-star")
    nodes = links.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return nodes.unionByName(links.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct()


def _ordered(edges: DataFrame) -> DataFrame:
    """Distinct links with a < b."""
    return edges.filter(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
