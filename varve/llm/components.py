"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varve.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node of ``edges`` (a, b) the smallest node it can reach.

    Each round replaces every edge by edges to the smallest neighbour, first for the larger
    neighbours of each node, then for the smaller ones. The number of rounds grows with the
    logarithm of the nodes. Groupings keep one value per node, so a node with very many
    edges is no heavy task. Every round is written to the shared folder, which cuts the lineage.
    """
    edges = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges, before = stored(edges.distinct(), "edges"), None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        larger = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        larger = larger.where("a != b").distinct()
        least = larger.groupBy("a").agg(F.min("b").alias("least"))
        smaller = larger.join(least, "a").select(
            F.when(F.col("b") == F.col("least"), F.col("a")).otherwise(F.col("b")).alias("a"),
            F.col("least").alias("b"),
        )
        edges = stored(smaller.where("a != b").distinct(), "edges")
        size = edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.lit(0))).first()
        if size == before:
            break
        before = size
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
