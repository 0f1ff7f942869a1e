"""Connected components of a graph given as an edge table, by alternating star contraction.

A large star links every larger neighbour of a node to the node's smallest neighbour, a small star the node itself
and its smaller neighbours. Repeated in turn they leave one star per component after a logarithmic number of
rounds. Each round is a combinable minimum and a join on the node, so a node with very many edges is split by the
adaptive skew join; the edges never leave the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merclake.llm.common import store


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # an edge goes from the larger node to the smaller one
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", "m").toDF("u", "v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge; root is the smallest node of its component. ``edges`` has two
    columns of integers; null and equal ends are no edges."""
    a, b = edges.columns
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull())
    now = store(now.where("u <> v").distinct(), "edges")
    seen = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
        if state == seen or not state["n"]:
            break
        seen = state
        now = store(_small_star(_large_star(now)), "edges")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(nodes.select("root", "root").distinct())
