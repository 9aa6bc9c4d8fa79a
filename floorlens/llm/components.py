"""Connected components of an edge table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floorlens.session import pin, unpin


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) of all nodes of edges ``a``, ``b``.

    Each round takes the smallest label among a node and its neighbours, then the label of that label, so
    labels travel along a path in steps that double. Every frame is written before it is joined: both sides
    are plain scans, and Spark can split the key of a node with many neighbours. Minima are combined before
    they are shuffled.
    """
    edges = edges.where("a <> b")
    both = pin(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = pin(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).select("node", F.least("node", "label").alias("label")))
    while True:
        heard = both.join(labels, F.col("b") == F.col("node")).select(F.col("a").alias("node"), "label", F.lit(None).cast("boolean").alias("own"))
        own = labels.select("node", "label", F.lit(True).alias("own"))
        hooked = pin(
            heard.union(own).groupBy("node").agg(F.min("label").alias("label"), F.min(F.when(F.col("own"), F.col("label"))).alias("before"))
        )
        above = hooked.select(F.col("node").alias("label"), F.col("label").alias("above"))
        moved = pin(hooked.join(above, "label").select("node", F.col("above").alias("label"), "before"))
        settled = moved.where("label <> before").limit(1).count() == 0
        unpin(hooked, labels)
        if settled:
            unpin(both)
            return moved.select("node", F.col("label").alias("component"))
        labels = moved
