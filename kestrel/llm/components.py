"""Connected components over an edge table, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import met, written


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a``, ``b``); ``root`` is the
    smallest node reachable.

    Each round every node takes the smallest label among its neighbours, then
    the label of its label.  Both are joins and map-side combined minima, so a
    node with very many links never meets in one task unsplit.  Rounds are
    written to the shared folder; they end when no label changes."""
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                   .where("a <> b").distinct(), "cc-edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                     .select("node", F.least("node", "m").alias("root")), "cc-labels")
    while True:
        near = (met(both, labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("n2")).agg(F.min("root").alias("m")))
        low = met(labels, near, labels["node"] == near["n2"]).select("node", "root", F.least("root", "m").alias("low"))
        low = written(low, "cc-low")
        # a label is itself a node: follow it one step
        jump = low.select(F.col("node").alias("via"), F.col("low").alias("next"))
        step = written(met(low, jump, low["low"] == jump["via"])
                       .select("node", "root", F.least("low", "next").alias("new")), "cc-step")
        changed = step.where("new <> root").limit(1).count()
        labels = step.select("node", F.col("new").alias("root"))
        if not changed:
            return labels
