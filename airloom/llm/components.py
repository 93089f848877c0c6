"""Connected components by alternating star steps, each a join and a grouping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.llm.common import save


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u long, v long); root is the least node reachable.

    Alternates the large-star and small-star steps until no edge changes: a
    number of rounds in the order of the logarithm of the longest path. Each
    round's edges are written below the checkpoint folder; the driver sees
    two numbers a round. Self links and repeated edges do no harm; an empty
    table gives an empty result.
    """
    now = save(_directed(edges), "component-edges")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        now = save(_small_star(_large_star(now)), "component-edges")
    # Every remaining edge points from a node to its root.
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _directed(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger end to its smaller."""
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node are linked to its least neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return _directed(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u")
    return _directed(moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(moved.select("u", F.col("m").alias("v"))))
