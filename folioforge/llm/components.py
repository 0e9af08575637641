"""Connected components by alternating large and small stars; every round is written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm import shared


def _star(pairs: DataFrame) -> DataFrame:
    """pairs (u, v): each v linked to the smallest of u and its neighbours."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that an edge (a, b) of longs names; root is the component's smallest node.

    Loops and repeated edges do no harm; null ends are dropped. No edges give no rows. The minimum of a
    node's neighbours is combined before the shuffle; the join that follows is by an ordinary key, which
    adaptive execution splits where a hub holds many edges. Rounds grow with the logarithm of the longest path.
    """
    now = shared.materialize(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "edges")
    state = None
    while True:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _star(both).filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a < b").distinct()
        down = large.select(F.col("b").alias("u"), F.col("a").alias("v"))
        small = _star(down).select("m", F.explode(F.array("u", "v")).alias("b")).filter("m < b").select(F.col("m").alias("a"), "b").distinct()
        now = shared.materialize(small, "edges", instead=now)
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state or not seen[0]:
            return now.groupBy("b").agg(F.min("a").alias("a")).select(F.col("b").alias("node"), F.col("a").alias("root")).union(
                now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
            )
        state = seen
