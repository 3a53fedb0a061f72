"""Connected components by alternating star operations.

Each round is two shuffles of the edge list: every vertex links its larger neighbours to
its smallest one, then its smaller ones. The number of rounds grows with the logarithm
of the longest chain. Hubs are no problem: the smallest neighbour is a partial aggregate,
and the edges of a hub are joined to it by skew-splitting joins instead of being
collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import checkpointed


def _large_star(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with u > v: each neighbour larger than w is linked to w's smallest."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with u > v: u and its neighbours are linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m"))
    return others.unionByName(least).select("u", F.col("m").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every vertex that has an edge. ``edges`` holds integer columns
    ``a`` and ``b`` in any order; loops and nulls are ignored. The component is the
    smallest id that can be reached."""
    stars = checkpointed(
        edges.filter("a != b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    seen = None
    while True:
        state = stars.agg(F.count("u"), F.sum(F.hash("u", "v").cast("long"))).first()
        if state[0] == 0 or state == seen:
            break
        seen = state
        stars = checkpointed(_small_star(_large_star(stars)))
    roots = stars.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
