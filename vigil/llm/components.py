"""Connected components of a graph given as a table of edges, by rounds of smallest labels and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``edges`` (columns a, b: long); comp is the smallest node of its component.

    Each round takes the smallest label among a node and its neighbours, then the label of that label, so the rounds
    grow with the logarithm of a component's diameter. Labels are written after each round. A node's neighbours are
    combined before they are shuffled, so a node with very many edges is no large group.
    """
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct())
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("comp")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("via"))
        jump = labels.select(F.col("node").alias("via"), F.col("comp").alias("far"))
        moved = written(lower.join(jump, "via", "left").select("node", "old", F.least("via", F.coalesce("far", "via")).alias("comp")))
        changed = moved.filter("comp <> old").limit(1).count()
        labels = moved.select("node", "comp")
        if not changed:
            return labels
