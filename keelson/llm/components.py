"""Connected components of an edge table by repeated star contraction.

Each round hooks every node to the smallest node among its neighbours and
itself, then rewrites the edges to these labels: nodes that share a label
become one node. A component shrinks by at least half a round (every node
but its smallest has a smaller neighbour or gives its own label to one), so the
rounds grow with the logarithm of its size. All state is tables in the shared
folder; only a row count reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import stash


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node with an edge.

    ``edges`` has the columns ``a`` and ``b``; loops, repeats and either
    direction are allowed; an edge with a null end is no edge.
    """
    pairs = stash(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                  .distinct(), "cc-edges")
    labels = None
    while not pairs.isEmpty():
        ends = pairs.select(F.col("a").alias("node"), F.col("a").alias("to")).unionByName(
            pairs.select(F.col("b").alias("node"), F.col("a").alias("to")))
        parent = stash(ends.groupBy("node").agg(F.min("to").alias("parent")), "cc-parent")
        # A parent may itself have hooked on: follow one step further.
        up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        parent = stash(parent.join(up, "parent", "left").select(
            "node", F.coalesce("grand", "parent").alias("parent")), "cc-hook")
        labels = parent.select("node", F.col("parent").alias("component")) if labels is None else stash(
            labels.join(parent.withColumnRenamed("node", "component"), "component", "left")
            .select("node", F.coalesce("parent", "component").alias("component"))
            , "cc-labels")
        low = parent.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        high = parent.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        pairs = stash(pairs.join(low, "a").join(high, "b").filter("pa <> pb")
                      .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "cc-edges")
    if labels is None:
        return pairs.select(F.col("a").alias("node"), F.col("a").alias("component"))
    return labels
