"""Connected components of an undirected graph given as edges, in DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; ``root`` is the smallest
    node reachable.  Each round takes the smallest label among the neighbours and
    then the label of that label, so paths shorten by more than half; every round
    is written to the shared folder.  Only a count of changes reaches the driver.
    Labels only fall and stay inside the component, so the rounds end; they end
    when no label changed, which is when each component has one label.
    """
    once = stored(edges.where("a <> b").select("a", "b"), "cc-links")
    both = stored(once.unionAll(once.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-edges")
    labels = stored(both.groupBy(F.col("a").alias("node"))
                    .agg(F.least(F.first("a"), F.min("b")).alias("root")), "cc-labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near")))
        lower = labels.join(near, "node").select("node", F.least("root", "near").alias("root"),
                                                 F.col("root").alias("was"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("far"))
        step = stored(lower.join(jump, "root", "left")
                      .select("node", F.least("root", "far").alias("root"), "was"), "cc-labels")
        labels = step.select("node", "root")
        if step.where("root <> was").isEmpty():
            return labels
