"""Connected components of an edge table, by repeated minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import staged


def components(edges: DataFrame) -> DataFrame:
    """node and label, the smallest node reachable, of every node in the written edges (a, b) of any one sortable type.

    Each turn takes the smallest label around a node and then that label's own label, so long chains need few turns. A
    node with very many neighbours is a minimum that each task first takes on its own. Every turn is written, which cuts
    the lineage. Nothing goes to the driver but the count of labels that changed.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = staged(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("label")), "labels")
    while True:
        own = labels.select(F.col("node").alias("b"), "label")
        near = both.join(own, "b").groupBy("a").agg(F.min("label").alias("near"))
        better = labels.join(near, labels["node"] == near["a"]).select("node", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        turned = staged(better.join(jump, "next").select("node", F.least("next", "far").alias("next"), "label"), "labels")
        moved = turned.where(F.col("label") != F.col("next")).limit(1).count()
        labels = turned.select("node", F.col("next").alias("label"))
        if not moved:
            return labels
