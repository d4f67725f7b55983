"""Connected components of an edge table, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and component (the smallest node reachable) of every node that has an edge.

    Each round takes the smallest label next to a node (combined before the shuffle) and then the label's own label, so
    paths halve; rounds end when nothing changes. A round's labels are a written table, so none repeats an earlier one.
    """
    both = written(edges.select(F.col(a).alias("node"), F.col(b).alias("other")).unionByName(edges.select(F.col(b).alias("node"), F.col(a).alias("other"))).distinct(), "edges")
    labels = written(both.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("component").alias("near"))
        lower = labels.join(near, "node").select("node", F.least("component", "near").alias("component"), F.col("component").alias("old"))
        lower = written(lower, "lower")
        up = lower.select(F.col("node").alias("component"), F.col("component").alias("up"))
        after = lower.join(up, "component", "left").select("node", F.least("component", F.coalesce("up", "component")).alias("component"), "old")
        after = written(after, "labels")
        if after.filter("component <> old").isEmpty():
            return after.select("node", "component")
        labels = after.select("node", "component")
