"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertag.llm.storage import stage


def _toward_minimum(edges: DataFrame, all_neighbours: bool) -> DataFrame:
    """One star step on edges (a, b) with a > b.

    Every node finds the smallest of itself and its neighbours (only the smaller neighbours in the
    second kind of step) and hands that on to the neighbours on the other side. Minima are combined
    before the shuffle, and the join leaves nodes with very many edges to Spark's skew handling.
    """
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    seen = edges.unionByName(turned) if all_neighbours else edges
    lowest = seen.groupBy("a").agg(F.min("b").alias("low"))
    lowest = lowest.select("a", F.least("a", "low").alias("low"))
    if all_neighbours:
        # Larger neighbours of each node go to the smallest node around it.
        found = turned.join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        found = edges.join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        found = found.unionByName(lowest.select("a", F.col("low").alias("b")))
    return found.where("a > b").distinct()


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """The smallest node that each node reaches: ``node``, ``component``.

    Nodes without an edge to another node are absent, so an empty table gives an empty result.
    Rows with a null end and loops are ignored; repeated and turned edges count once. Steps
    alternate until no edge changes, a number that grows with the logarithm of the longest path.
    Each step is a table in the shared folder.
    """
    a, b = F.col(left), F.col(right)
    current = stage(
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"), (a != b).alias("_ends"))
        .where("_ends")
        .drop("_ends")
        .distinct(),
        "edges",
    )
    state = _state(current)
    while True:
        wide = stage(_toward_minimum(current, all_neighbours=True), "edges")
        current = stage(_toward_minimum(wide, all_neighbours=False), "edges")
        before, state = state, _state(current)
        if state == before:
            break
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _state(edges: DataFrame) -> tuple:
    """A digest of the set of edges."""
    digest = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(digest)).first())
