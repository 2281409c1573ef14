"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root): for every node of ``links`` (a, b, longs) the smallest node it is connected to.

    Every step replaces edges by edges to smaller nodes and keeps the components; the number of
    steps grows with the logarithm of the longest chain. Each step is written to the shared folder,
    and only a count and a checksum reach the driver. A node with very many neighbours is a
    skewed join key at worst: minima are combined before they are shuffled.
    """
    edges = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .distinct(), "edges")
    before = None
    while True:
        # large star: every larger neighbour is tied to the smallest of the neighbourhood
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        grown = (both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .filter("a <> b").distinct())
        # small star: every node and its smaller neighbours are tied to the smallest of them
        least = grown.groupBy("a").agg(F.min("b").alias("m"))
        tied = grown.join(least, "a")
        edges = stored(tied.select(F.col("b").alias("a"), F.col("m").alias("b"))
                       .union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = now
