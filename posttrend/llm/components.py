"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posttrend.session import cut_lineage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large: hangs the larger neighbours of every node on its smallest neighbour; small: the smaller ones and itself."""
    if large:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    else:
        around = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    hung = around.join(least, "u")
    if large:
        moved = hung.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = hung.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def components(links: DataFrame, max_rounds: int = 50) -> DataFrame:
    """``node, component`` for all nodes of the links ``a, b``; a component is named by its smallest node.

    Each round leaves stars that grow until nothing moves; rounds grow with the logarithm of a component's size.
    """
    edges = cut_lineage(links.where("a <> b").select("a", "b").distinct())
    mark = None
    for _ in range(max_rounds):
        edges = cut_lineage(_star(_star(edges, True), False))
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    # A small-star step ends with every edge leading from a node to a smaller one; settled, to the root.
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
