"""Connected components of links, by DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settled, stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, label: the smallest node that each linked node reaches; the tables of the rounds are deleted."""
    return settled(lambda: _components(links, a, b), "components")


def _components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node, label: the smallest node that each linked node reaches.

    Each round takes the smallest label among neighbours and then the label of that label (pointer jumping), so long
    chains halve. Links of null nodes and of a node with itself are left out. Each round is a table in the shared folder.
    """
    there = links.select(F.col(a).alias("node"), F.col(b).alias("other")).where("node <> other")
    both = stored(there.union(there.select("other", "node")).distinct(), "links")
    labels = stored(both.groupBy("node").agg(F.least(F.first("node"), F.min("other")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node").agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", F.least("label", "near").alias("step"), "label")
        jump = labels.select(F.col("node").alias("step"), F.col("label").alias("far"))
        new = stored(step.join(jump, "step").select("node", F.least("step", "far").alias("label"), (F.least("step", "far") < F.col("label")).alias("moved")), "labels")
        labels = new.select("node", "label")
        if new.where("moved").isEmpty():
            return labels
