"""Connected components of an edge table, by alternating star contraction.

Each half round replaces edges by edges to the smallest neighbour (Kiveris et al.,
2014); it ends after about log(n) rounds, also on long chains.  A node's minimum
is a partial aggregate, so hubs do not gather in one task; every round is written
to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.llm.common import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (a > b). Large: all neighbours above a node point to the least of its
    neighbourhood; small: a node and its neighbours below point to the least of them."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    moved = both.join(least, "a")
    if large:
        out = moved.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", limit: int = 100) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node with an edge.

    Edges may be repeated, reversed or loops; edges with a null end are ignored. Rounds go
    on until none changes an edge; ``limit`` rounds without an end (about 2 ** 50 nodes on a
    chain) are an error.
    """
    now = cut(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
              .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("a") != F.col("b"))).distinct(), "edges")
    mark = None
    for step in range(limit):
        now = cut(_star(_star(now, True), False), f"star-{step}")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError(f"components still change after {limit} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
