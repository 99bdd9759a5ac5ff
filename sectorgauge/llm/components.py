"""Connected components over any number of edges, by built-in functions only.

Each round alternates two steps on the edge list: every vertex hangs its larger
neighbours on its smallest neighbour, then its smaller ones. The list shrinks to stars
in a number of rounds that grows with the logarithm of the longest chain. Edges are
combined to minima before they move, so a vertex with a third of all edges arrives as
few rows. Rounds are stored tables: a lost executor costs a re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sectorgauge.sources.stages import stage


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    hung = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.where("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    hung = edges.join(least, "a")
    moved = hung.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``vertex, component`` of every vertex that is not the smallest of its component.

    Edges with a null end and loops count for nothing; repeated edges count once. The
    component is the smallest vertex. Vertices without a row are their own component.
    """
    a, b = F.col(left), F.col(right)
    start = edges.where(a.isNotNull() & b.isNotNull() & (a != b))
    current = stage(
        start.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "edges"
    )
    before = None
    while True:
        signature = current.agg(
            F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))
        ).first()
        if signature[0] == 0 or tuple(signature) == before:
            return current.select(F.col("a").alias("vertex"), F.col("b").alias("component"))
        before = tuple(signature)
        current = stage(_small(_large(current)), "edges")


