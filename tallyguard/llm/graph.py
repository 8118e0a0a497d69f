"""Connected components of a large graph, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyguard.llm.work import materialize


def components(links: DataFrame) -> DataFrame:
    """For each vertex of ``links(a long, b long)`` the smallest vertex that it reaches.

    Every round takes the smallest label among the neighbours and then follows labels one
    step (pointer jumping), so the number of rounds grows with the logarithm of the longest
    chain. Labels are written to the shared folder after each round; nothing is collected
    but the number of changes. A vertex with very many links only meets partial minima and
    joins that adaptive execution splits.
    """
    both = links.select("a", "b").where("a <> b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")).where("a <> b"))
    both = materialize(both, "links")
    labels = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("v"), F.least("a", "low").alias("c"))
    labels = materialize(labels, "labels")
    while True:
        near = (
            both.join(labels.withColumnsRenamed({"v": "b"}), "b")
            .groupBy(F.col("a").alias("v"))
            .agg(F.min("c").alias("near"))
        )
        lower = labels.join(near, "v").select("v", "c", F.least("c", "near").alias("low"))
        root = labels.select(F.col("v").alias("low"), F.col("c").alias("of_low"))
        moved = materialize(
            lower.join(root, "low", "left").select("v", F.coalesce(F.least("low", "of_low"), "low").alias("n"), "c"), "labels"
        )
        changed = moved.where("n <> c").limit(1).count()
        labels = moved.select("v", F.col("n").alias("c"))
        if not changed:
            return labels
