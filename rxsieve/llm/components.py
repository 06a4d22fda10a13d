"""Connected components of a graph kept in a table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxsieve.llm.store import drop_stored, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang the larger neighbours of each node on its least neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang each node and its smaller neighbours on the least of them; every edge has a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    joined = edges.join(least, "a")
    return joined.select("a", F.col("least").alias("b")).unionByName(joined.where("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id``, ``component``: the least id reachable, for each node of an edge.

    Two rounds halve the depth of a tree at least, so their number grows as the logarithm of the longest
    path. Each round is written to the shared folder. Edges from a node to itself and with NULL ends are
    ignored; no edges give no rows.
    """
    now = stored(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(F.col(a) != F.col(b)).distinct(), "edges")
    while True:
        after = stored(_small_star(_large_star(now)), "edges")
        drop_stored(now)
        now = after
        # a forest of stars: one edge for each node, and no centre hangs on another
        if now.groupBy("a").count().where("count > 1").limit(1).count() == 0 and now.join(now.select(F.col("a").alias("b")), "b", "left_semi").limit(1).count() == 0:
            break
    centres = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(centres)
