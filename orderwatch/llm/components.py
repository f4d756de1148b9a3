"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderwatch.llm.common import cut


def _stars(edges: DataFrame) -> DataFrame:
    """One round. Edges lead from a larger node `u` to a smaller one `v`, and so do those returned."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    least = large.groupBy("u").agg(F.min("v").alias("low"))
    small = large.join(least, "u").filter("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return small.unionByName(least.select("u", F.col("low").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Per node of `edges` (u, v): `node` and `component`, the smallest node it is connected with.

    Rounds go on until nothing changes, about the logarithm of the longest path. A node with very many edges is
    only ever a join key against one row, or a group that is combined before its shuffle. Null ends and edges
    from a node to itself are passed over.
    """
    u, v = F.greatest("u", "v"), F.least("u", "v")
    edges = edges.filter("u is not null and v is not null and u != v")
    edges = cut(edges.select(u.alias("u"), v.alias("v")).distinct())
    mark = None
    while True:
        found = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if found == mark:
            break
        mark, edges = found, cut(_stars(edges))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
