"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def connected(links: DataFrame, scratch: Scratch) -> DataFrame:
    """links: a, b (long). Returns (id, comp) of every id in a link; comp is the smallest id of its component.

    Each round hooks every label to the smallest label next to it, follows two more hooks, and contracts the links to
    labels that still differ; hubs cost no more than their links, since minima are taken in the map tasks first."""
    links = scratch.keep(links.select("a", "b").where("a <> b").distinct())
    ids = links.select(F.col("a").alias("id")).union(links.select("b")).distinct()
    labels = scratch.keep(ids.withColumn("comp", F.col("id")))
    edges, first = links, True
    while first or not edges.isEmpty():
        first = False
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = scratch.keep(both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("to")))
        for _ in range(2):
            far = hooks.select(F.col("a").alias("to"), F.col("to").alias("_far"))
            new = scratch.keep(hooks.join(far, "to", "left").select("a", F.coalesce("_far", "to").alias("to")))
            scratch.drop(hooks)
            hooks = new
        moved = scratch.keep(labels.join(hooks, F.col("comp") == F.col("a"), "left").select("id", F.coalesce("to", "comp").alias("comp")))
        ends = hooks.select(F.col("a").alias("b"), F.col("to").alias("_b"))
        near = edges.join(hooks, "a").select("b", F.col("to").alias("_a")).join(ends, "b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
        left = scratch.keep(near.where("a <> b").distinct())
        scratch.drop(labels, hooks, *([] if edges is links else [edges]))
        labels, edges = moved, left
    scratch.drop(links, edges)
    return labels
