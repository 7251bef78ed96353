"""Connected components of a large graph, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.llm.shared import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the smallest node reachable.

    Alternating large-star and small-star rounds: nodes hang their neighbours on the
    smallest one they know, until nothing changes. Each round is two aggregations and two
    joins over the remaining links, written to the shared folder; a round at least halves
    the longest way to the root. Nothing is collected but a count and a checksum.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct())
    state = _state(edges)
    while True:
        edges = stored(_small_star(_large_star(edges)))
        now = _state(edges)
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select("v", "v").distinct()
            )
        state = now


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node are linked to the smallest node around it."""
    both = edges.union(edges.select("v", "u")).toDF("n", "x")
    least = both.groupBy("n").agg(F.min("x").alias("m")).select("n", F.least("n", "m").alias("m"))
    larger = both.filter("x > n").join(least, "n")
    return larger.select(F.col("x").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, are linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    smaller = edges.join(least, "u").select(F.col("v").alias("x"), "m").filter("x > m")
    return smaller.union(least.select("u", "m")).toDF("u", "v").distinct()
