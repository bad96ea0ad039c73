"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` (a, b) to (node, root): the smallest node of each component.

    Alternating large-star and small-star rounds: every node links its larger
    neighbours (then its smaller ones and itself) to its smallest neighbour.
    The smallest neighbour comes from a pre-aggregated minimum and a join that
    AQE can split, so no neighbour list is ever held; the number of edges
    never grows, and rounds are logarithmic in the longest path.  Each round
    is cut by ``checkpoint()``.  Raises if ``max_rounds`` do not suffice."""
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    now = now.checkpoint()
    before = None
    for _ in range(max_rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = (both.where("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = (joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        now = small.checkpoint()
        # all stars: no node is both below one and above another, and nothing moved
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
    raise RuntimeError(f"components: {max_rounds} rounds did not suffice")
