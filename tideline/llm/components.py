"""Connected components of a graph given by its edges, without collecting it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import checkpointed


def _lowest(edges: DataFrame) -> DataFrame:
    """The smallest of every node and its neighbours; summed up before the shuffle."""
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected with, for the nodes of ``edges`` (u, v).

    Alternates two steps until nothing changes: every node hands the smallest of its neighbours to
    the larger ones, then to the smaller ones. Both keep the graph's components and flatten them to
    stars in a number of rounds that grows with the logarithm of their diameter. Nodes compare
    themselves by minimum and join. The minima are written before the join, so that both of its sides come
    straight from a shuffle: adaptive execution can then split a node with very many neighbours.
    """
    edges = checkpointed(edges.where("u <> v").select("u", "v").distinct())
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(checkpointed(_lowest(both)), "u").where("v > u AND v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # Edges now point from a node to a smaller one.
        low = checkpointed(_lowest(large))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        edges = checkpointed(small)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
