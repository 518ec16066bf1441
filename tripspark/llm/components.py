"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.llm.frames import stored


def components(edges: DataFrame, one: str = "u", other: str = "v") -> DataFrame:
    """Rows (node, component): the smallest node that can be reached, for every node of an edge.

    Each round takes the smallest label among a node and its neighbours, then the label of that label, so the number of
    rounds grows with the logarithm of the longest shortest path. A round is written before the next one starts: lineage
    stays short and a lost executor costs one round at most. Sums over the edges of a node are combined before the
    shuffle, so a node with very many edges is no hot key.
    """
    pairs = edges.select(F.col(one).cast("long").alias("u"), F.col(other).cast("long").alias("v")).where(
        F.col("u").isNotNull() & F.col("v").isNotNull()
    )
    both = stored(pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("least"))
    labels = stored(labels.select("node", F.least("node", "least").alias("component")), "labels")
    while True:
        near = (
            both.join(labels, both["v"] == labels["node"])
            .groupBy("u")
            .agg(F.min("component").alias("near"))
        )
        low = labels.join(near, labels["node"] == near["u"]).select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("low")
        )
        again = low.select(F.col("node").alias("of"), F.col("low").alias("next"))
        jumped = low.join(again, low["low"] == again["of"]).select(
            "node", "old", F.least("low", "next").alias("component")
        )
        jumped = stored(jumped, "labels")
        labels = jumped.select("node", "component")
        if not jumped.where(F.col("component") < F.col("old")).limit(1).count():
            return labels
