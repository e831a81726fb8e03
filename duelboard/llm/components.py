"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelboard.llm.tables import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long); component is its smallest node.

    Each round takes the smallest label among a node's neighbours and then the label of
    its label, which halves long chains. Labels are written to the shared folder after
    each round, so a lost executor costs one round at most. Hubs are met only by partial
    minima and by joins that adaptive execution can split; nothing is collected.
    """
    both = cut(
        edges.where("a <> b").select("a", "b").unionByName(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "edges",
    )
    labels = cut(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).select(F.col("a").alias("node"), "label"), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        stepped = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        moved = cut(stepped.join(jump, "label").select("node", "old", F.least("label", "further").alias("label")), "labels")
        labels = moved.select("node", "label")
        if moved.where("label <> old").isEmpty():
            return labels.select("node", F.col("label").alias("component"))
