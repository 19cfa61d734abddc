"""Connected components of an edge table.

Alternating large-star and small-star steps (Kiveris et al., "Connected Components in
MapReduce and Beyond", 2014): every step points nodes at smaller neighbours, until each
component is a star around its smallest node. Edges stay distributed; the driver sees a
count and a checksum per round. No node's neighbours are gathered: a step is a minimum per
node and a join, whose hot keys AQE can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import stored


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` for every node of an edge between different nodes.

    ``component`` is the smallest node that can be reached. Null ends, loops and repeated
    edges are ignored; an empty table gives an empty result.
    """
    links = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v"))
    )
    links = stored(links.distinct(), "links")
    mark = None
    while True:
        found = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
        if found["n"] == 0 or (found["n"], found["s"]) == mark:
            break
        mark = (found["n"], found["s"])
        links = stored(_small_star(_large_star(links)), "links")
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour, or to the node."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is tied to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    tied = links.join(least, "u").filter(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(least.select("u", F.col("m").alias("v"))).distinct()
