"""Connected components of a table of links, by shuffles only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onsetlab.llm.scratch import cut


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node of ``links`` (columns ``a`` and ``b``).

    A component is named by its smallest node. Nodes of one component take the
    smallest label among their neighbours and then the label of their label,
    until nothing changes, so the number of rounds follows the logarithm of the
    longest chain. Links may repeat, stand in any direction and lead from a
    node to itself; without links there are no nodes.
    """
    both = cut(
        links.select("a", "b").union(links.select("b", "a")).where("a IS NOT NULL AND b IS NOT NULL").distinct()
    )
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("component")))
    while True:
        told = both.join(labels.select(F.col("node").alias("b"), "component"), "b")
        least = told.groupBy(F.col("a").alias("node")).agg(F.min("component").alias("told"))
        nearer = labels.join(least, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "told").alias("next")
        )
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("last"))
        new = cut(nearer.join(jump, "next").select("node", "old", F.least("next", "last").alias("component")))
        changed = new.where("component <> old").limit(1).count()
        labels = new.select("node", "component")
        if not changed:
            return labels
