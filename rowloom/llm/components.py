"""Connected components of a distributed edge list by alternating large and small stars.

Every round replaces edges by edges to smaller neighbours, until each node points to the smallest node of its
component. Rounds are written to the shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.session import stored


def components(edges: DataFrame) -> DataFrame:
    """(a, b) to (node, root): root is the smallest node that is reachable. Nodes without another are left out.

    Nulls, loops and repeated edges are ignored; an empty list of edges gives an empty table.
    """
    current = stored(_directed(edges.select("a", "b")), "edges")
    before = None
    while True:
        now = current.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if now == before or not now[0]:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
        current = stored(_small_star(_large_star(current)), "edges")


def _directed(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger to the smaller node."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Join the larger neighbours of every node to the smallest node among it and its neighbours."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return _directed(both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.least("m", "u").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Join every node's smaller neighbours, and the node, to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return _directed(edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m")))
