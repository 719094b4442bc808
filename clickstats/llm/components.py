"""Connected components by alternating star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstats.llm.tables import cut


def _key(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("v", "u") % (1 << 40)).alias("h")).first()
    return row["n"], row["h"]


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root): for each node of ``links`` (a, b: long) the smallest node of its component.

    Each round hangs the larger neighbours of a node on its smallest
    neighbour, then the smaller ones. Components of any shape are stars after
    about the logarithm of their size in rounds. Every round is written to the
    shared checkpoint folder; nothing but a count and a checksum of the edges
    comes to the driver.
    """
    edges = cut(links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("v <> u").distinct())
    before = _key(edges)
    while True:
        both = edges.unionAll(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("x"), F.least("v", "m").alias("m"))
        # Larger neighbours u of x go to x's smallest.
        large = both.where("u > v").join(low, F.col("v") == F.col("x")).select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = cut(large.where("v <> u"))  # at most as many rows as edges, repeats included
        least = large.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("x"), "m")
        # Smaller neighbours u of v go to v's smallest, and v itself.
        small = large.join(least, F.col("v") == F.col("x")).select(F.col("u").alias("v"), F.col("m").alias("u"))
        edges = cut(small.unionAll(least.select(F.col("x").alias("v"), F.col("m").alias("u"))).where("v <> u").distinct())
        now = _key(edges)
        if now == before:
            roots = edges.select("u").distinct().select(F.col("u").alias("node"), F.col("u").alias("root"))
            return edges.groupBy("v").agg(F.min("u").alias("root")).select(F.col("v").alias("node"), "root").unionAll(roots)
        before = now
