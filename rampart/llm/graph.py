"""Connected components by repeated joins: minimum label over neighbours, then pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rampart.llm.common import discard, materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (src, dst, any direction,
    loops and repeats allowed): the component is its smallest node.

    Each round gives every node the least label among itself and its
    neighbours and then that label's own label, so chains halve; it ends when
    no label changes. Labels live in the shared folder, nothing on the driver."""
    both = materialize(edges.select("src", "dst").union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct(), "edges")
    labels = materialize(both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("m"))
                         .select("node", F.least("node", "m").alias("component")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("dst"), "component"), "dst")
                .groupBy(F.col("src").alias("node")).agg(F.min("component").alias("m")))
        low = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "m").alias("component"))
        low = materialize(low, "labels")
        jump = low.select(F.col("node").alias("component"), F.col("component").alias("further"))
        new = materialize(low.join(jump, "component").select("node", "old", F.least("component", "further").alias("component")), "labels")
        changed = not new.filter(F.col("old") != F.col("component")).isEmpty()
        discard(low)
        discard(labels)
        labels = new
        if not changed:
            discard(both)
            return labels.select("node", "component")
