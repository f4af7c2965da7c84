"""Connected components of a link table, without collecting links anywhere.

Each round gives every node the smallest label among itself and its
neighbours (one map-side aggregate) and then jumps: the label becomes the label
of the label.  Every round is a written table, so a lost executor costs one
round at most.  Stars settle in two or three rounds, a chain of n links in about
log(n).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, label)`` for each node of ``links``; label = smallest node reachable."""
    one = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    edges = cut(one.union(one.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = cut(edges.groupBy(F.col("u").alias("node")).agg(F.least(F.first("u"), F.min("v")).alias("label")), "labels")
    total = None
    while True:
        # neighbours' smallest label; the label of the own label
        low = (
            edges.join(labels, edges["v"] == labels["node"])
            .groupBy(F.col("u").alias("n1"))
            .agg(F.min("label").alias("low"))
        )
        near = labels.join(low, F.col("node") == F.col("n1"), "left").select(
            "node", F.least("label", "low").alias("label")
        )
        near = cut(near, "labels")
        up = near.select(F.col("node").alias("n2"), F.col("label").alias("up"))
        labels = cut(
            near.join(up, F.col("label") == F.col("n2"), "left").select("node", F.least("label", "up").alias("label")),
            "labels",
        )
        # labels only ever fall, so an unchanged sum means that nothing moved
        now = labels.agg(F.sum(F.col("label").cast("decimal(38,0)")).alias("s")).collect()[0]["s"]
        if now == total:
            return labels
        total = now
