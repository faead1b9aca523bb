"""Connected components of an edge table, by alternating large-star and
small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tilewright.functions.joins import spread_join
from tilewright.functions.storage import forget, written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node of each component, for every node
    that has an edge. edges: (a, b) of one orderable type; loops, repeats and
    either direction are welcome, rows with a null end are ignored.

    Each round is two joins and two minimum aggregations; a hub's edges are
    combined before the shuffle, its neighbours are dealt to many tasks, and no
    neighbour list is ever built. Rounds grow with the logarithm of the nodes.
    """
    now = written(_down(edges.select("a", "b").where("a is not null and b is not null")), "cc")
    seen = None
    while True:
        state = Observation()
        after = _star(_star(now, larger=True), larger=False).observe(state, F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("hash"))
        after = written(after, "cc")
        forget(now)
        now = after
        if state.get == seen:
            break
        seen = state.get
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())


def _down(edges: DataFrame) -> DataFrame:
    """Every edge once, from the larger end a to the smaller end b."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Links each node's larger (or else smaller and own) neighbours to the
    least node around it."""
    if larger:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        moved = spread_join(both.where("b > a"), least, ["a"], by=["b"], how="inner").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("least"))
        moved = spread_join(edges, least, ["a"], by=["b"], how="inner").select("b", "least").union(least.select("a", "least")).toDF("a", "b")
    return _down(moved)
