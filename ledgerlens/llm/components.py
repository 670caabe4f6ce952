"""Connected components of a link table, without collecting links or components anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.sources.scratch import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in `links` (a, b); the component is its smallest node.

    Each round a node takes the smallest label among itself, its neighbours and
    its label's own label. The labels of a round are written to the shared
    folder, so no round depends on the one before it being recomputed. Joins on
    a node with many links or a label with many nodes are plain equi-joins,
    which adaptive execution splits; minima are combined before they are shuffled.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = stored(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")))
    while True:
        old = labels.select(F.col("node").alias("b"), "label")
        near = both.join(old, "b").groupBy("a").agg(F.min("label").alias("near"))
        hooked = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        beyond = labels.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        jumped = hooked.join(beyond, "label").select("node", "old", F.least("label", "beyond").alias("label"))
        fresh = stored(jumped)
        labels = fresh.select("node", "label")
        if fresh.filter("label <> old").limit(1).count() == 0:
            return labels.withColumnRenamed("label", "component")
