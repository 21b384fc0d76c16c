"""Connected components of a link table, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); component is the smallest node that can be reached.

    Each round hangs every neighbour on the smallest one (large star, then small star), which at least halves long
    paths. The rounds end when the links no longer change; every round is written to the shared folder.
    """
    edges = stored(links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = edges.union(edges.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        up = large.where(F.col("a") != F.col("b")).distinct()
        lowest = up.groupBy("a").agg(F.min("b").alias("m"))
        small = up.join(lowest, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        )
        edges = stored(small.select("e.a", "e.b").where(F.col("a") != F.col("b")).distinct())
        state = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        ).first()
        if state == before:
            break
        before = state
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(edges.select("b", "b")).groupBy("node").agg(F.min("component").alias("component"))
