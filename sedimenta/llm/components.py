"""Connected components by grouped aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.session import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of all nodes in the edges (a, b); the label is the component's smallest node.

    Every round takes the smallest label of a node's neighbours and then the label of that label, so
    that chains shorten by more than half. Rounds are written to the shared folder.
    """
    both = stage(
        edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct().toDF("node", "other"), "edges"
    )
    labels = stage(both.groupBy("node").agg(F.least("node", F.min("other")).alias("label")), "labels")
    while True:
        near = both.join(labels.toDF("other", "label"), "other").groupBy("node").agg(F.min("label").alias("near"))
        seen = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next"))
        root = labels.toDF("next", "root")
        jumped = stage(
            seen.join(root, "next").select("node", "label", F.least("next", "root").alias("next")), "labels"
        )
        changed = jumped.filter("label <> next").limit(1).count()
        labels = jumped.select("node", F.col("next").alias("label"))
        if not changed:
            return labels
