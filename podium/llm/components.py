"""Connected components by alternating large-star and small-star steps.

Each step links nodes to the smallest neighbour they know of, so paths halve
and hubs form; the edges never outnumber those of the input by more than the
nodes. No component is ever gathered: a hub's neighbours are found by an
aggregate and a join. (Kiveris et al., "Connected Components in MapReduce and
Beyond", 2014.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.sources import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over ``edges`` (a > b)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both if large else edges
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = near.join(least, "a")
    if large:
        out = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return out.where(F.col("a") > F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node with an edge.

    ``edges`` has two columns of comparable ids; direction, repeated edges and
    loops do not matter, and edges with a null are left out. Each round is
    written to the shared folder, so a lost executor costs one step.
    """
    a, b = (F.col(c) for c in edges.columns)
    edges = materialize(
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .where((a != b) & a.isNotNull() & b.isNotNull())
        .distinct(),
        "edges",
    )
    before = None
    while True:
        stars = materialize(_star(_star(edges, large=True), large=False), "stars")
        now = stars.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).head()
        if now == before:
            break
        before, edges = now, stars
    centres = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(centres)
