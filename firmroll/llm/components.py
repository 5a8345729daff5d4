"""Connected components of a graph given by its edges, by alternating stars.

Every round writes its edges to the shared folder, so lineage stays short and no edge comes to the driver. Edges always
point to the smaller node, so they are done when they are stars: each node points to the least of its component. Rounds grow with the logarithm of the longest path. Both sides of each join are plain scans, so that adaptive
execution splits a node with very many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmroll.llm.common import stored


def _hooked(pairs: DataFrame) -> DataFrame:
    """pairs (u, v), a plain scan: every v, and u itself, points to the least of v and u."""
    least = stored(pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least")), "least")
    return pairs.join(least, "u").select("u", "v", "least")


def _edges(df: DataFrame) -> DataFrame:
    return df.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge down, to a node that has none."""
    several = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    onward = edges.join(edges.select(F.col("v").alias("u")), "u", "left_semi")
    return several.isEmpty() and onward.isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """edges (u, v), whole numbers in any direction -> (node, root) for every node with an edge, root the least node."""
    current = stored(_edges(edges.select("u", "v").where("u is not null and v is not null")), "edges")
    while not _are_stars(current):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _hooked(both).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        small = _hooked(stored(_edges(large), "large"))
        current = stored(
            _edges(
                small.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(
                    small.select("u", F.col("least").alias("v"))
                )
            ),
            "edges",
        )
    roots = current.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
