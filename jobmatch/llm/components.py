"""Connected components of links between nodes of any orderable type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, stored


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``links(a, b)``; nodes share a label if and only
    if links join them.

    Each round every node takes the smallest of itself and its neighbours, then that
    node's choice, and the links are redrawn between what was chosen; the number of nodes
    left falls by half or more.  Minima are combined before they are shuffled and the
    joins are on keys with one row on one side, so a node with very many links is split
    like any skewed key."""
    links = stored(links.select("a", "b").where("a <> b").distinct(), "links")
    labels = None
    while links.take(1):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = stored(both.groupBy("a").agg(F.min("b").alias("m"))
                      .select(F.col("a").alias("node"), F.least("a", "m").alias("to")), "near")
        hop = near.select(F.col("node").alias("to"), F.col("to").alias("label"))
        chosen = stored(near.join(hop, "to").select("node", "label"), "chosen")
        forget(near)
        if labels is None:
            labels = chosen
        else:
            next_ = chosen.select(F.col("node").alias("label"), F.col("label").alias("next"))
            labels = stored(labels.join(next_, "label", "left")
                            .select("node", F.coalesce("next", "label").alias("label")), "labels")
        to_a = chosen.select(F.col("node").alias("a"), F.col("label").alias("la"))
        to_b = chosen.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        redrawn = (links.join(to_a, "a").join(to_b, "b").where("la <> lb")
                   .select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct())
        old, links = links, stored(redrawn, "links")
        forget(old)
    return labels if labels is not None else links.select(F.col("a").alias("node"), F.col("b").alias("label"))
