"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterqa.llm.base import written


def components(links: DataFrame) -> DataFrame:
    """(node, root) of all nodes in ``links`` (a, b); the root is the smallest node that can be reached.

    Labels spread to neighbours and jump to their label's label, until nothing changes: a number of rounds that
    grows with the logarithm of the longest chain. Each round is written, so none is computed again. A node with very
    many links meets them in skewed joins, which Spark splits, and in minima taken before the shuffle.
    """
    both = written(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("root")))
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "root"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        spread = written(
            labels.join(near, "node").select("node", F.col("root").alias("was"), F.least("root", "near").alias("root"))
        )
        far = spread.select(F.col("node").alias("root"), F.col("root").alias("far"))
        labels = written(spread.join(far, "root").select("node", "was", F.least("root", "far").alias("root")))
        moved = labels.filter(F.col("root") != F.col("was")).limit(1).count()
        labels = labels.select("node", "root")
        if not moved:
            return labels
