"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braidwork.session import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """``node, comp`` for the ends of ``links(a, b)``; ``comp`` is the smallest node of the component.

    Every round takes the smallest label among a node and its neighbours, then
    follows labels one step, so chains shrink by more than half per round. The
    labels of a round are written to the shared folder: a lost executor costs
    one round at most. Repeated links and loops are allowed; no links, no rows.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialize(both.distinct(), "edges")
    labels = materialize(
        edges.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("comp")), "labels"
    )
    while True:
        near = (
            edges.join(labels.select(F.col("node").alias("b"), "comp"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("comp").alias("near"))
        )
        lowered = labels.join(near, "node").select(
            "node", F.col("comp").alias("was"), F.least("comp", "near").alias("via")
        )
        target = labels.select(F.col("node").alias("via"), F.col("comp").alias("beyond"))
        stepped = materialize(
            lowered.join(target, "via").select("node", "was", F.least("via", "beyond").alias("comp")),
            "labels",
        )
        labels = stepped.select("node", "comp")
        if stepped.where(F.col("was") != F.col("comp")).isEmpty():
            return labels
