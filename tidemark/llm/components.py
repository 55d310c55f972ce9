"""Connected components of an edge table, as Spark joins (alternating star contraction)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each node's component, for every node with an edge to another.

    edges: columns a and b. Each round takes, for every node, the least neighbour (a map-side minimum) and hangs the
    others below it; rows stay linear in the edges. Every round is a written table, so a lost executor costs no more
    than that round. Rounds go on until one changes nothing; they are few, about the logarithm of the size.
    """
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    seen = None
    while True:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.where("a <> b").distinct()
        small_min = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(small_min, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = written(small.union(small_min).where("a <> b").distinct(), "edges")
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == seen:
            return now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = state
