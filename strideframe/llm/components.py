"""Connected components of a link table, by repeated joins.

Every node points at the smallest id it knows. A round lets each node take the smallest label among its own, its
neighbours' and its label's label, so long chains halve. Labels are stored in the shared folder after each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.sources import scratch


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``: the smallest id reachable. Null ends are left out."""
    links = links.where("a is not null and b is not null and a <> b").select("a", "b")
    both = scratch.store(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = scratch.store(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").select(F.col("a").alias("node"), "component")
        up = labels.withColumnRenamed("component", "hop").join(
            labels.select(F.col("node").alias("hop"), F.col("component")), "hop"
        )
        # a label adopts what its members have learnt, and members adopt their label's label
        down = near.join(labels.select("node", F.col("component").alias("hop")), "node").select(F.col("hop").alias("node"), "component")
        found = near.union(down).union(up.select("node", "component")).groupBy("node").agg(F.min("component").alias("component"))
        following = scratch.store(
            labels.withColumnRenamed("component", "old").join(found, "node", "left")
            .select("node", F.least("old", F.coalesce("component", "old")).alias("component"), "old"),
            "labels",
        )
        if following.where("component <> old").isEmpty():
            return labels
        labels = following.drop("old")
