"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlytics.llm.common import checkpointed


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b); the root is the smallest node reachable.

    Each round points the larger neighbours of a node at its smallest one, then its smaller
    neighbours; rounds end when nothing changes. A node's neighbours are never gathered:
    minima are combined before the shuffle, and AQE splits the joins on nodes with many links.
    """
    edges = checkpointed(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where(F.col("u") != F.col("v"))
        .distinct()
    )
    seen = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.where(F.col("v") > F.col("u"))
            .join(least.select("u", F.least("u", "m").alias("m")), "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where(F.col("u") != F.col("v"))
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .where(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = checkpointed(small)
        state = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        if state == seen:
            break
        seen = state
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )
