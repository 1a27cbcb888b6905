"""Connected components of a graph given as edges, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Ties each greater neighbour of a node to the least node around it."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Ties a node and its lesser neighbours to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``id, root`` for every node of the edges ``a, b``: root is the least node that it is linked with.

    A node with many edges is only ever aggregated by its minimum and joined, never collected. Rounds
    grow with the logarithm of the longest chain; each is written to the shared folder.
    """
    greater, lesser = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = staged(edges.where("a <> b").select(greater, lesser).distinct())
    before = None
    while True:
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if now == before or not now["n"]:
            break
        before = now
        edges = staged(_small_star(_large_star(edges)))
    own = edges.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("root"))
    return edges.select(F.col("a").alias("id"), F.col("b").alias("root")).unionAll(own)
