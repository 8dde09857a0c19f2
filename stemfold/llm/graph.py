"""Connected components by joins, for edges that no single task or driver could hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemfold.llm.common import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): component is the smallest node reachable.

    Every node takes the least label among its neighbours, gives it to the
    node that its old label names, and then follows its label one step. Labels
    fall until the ends of each edge agree; paths halve in each round. A node
    of any degree is only ever one side of an equi-join or a partial minimum,
    so a hot node is split by the skew join and pre-aggregated. Each round is
    written, so lost executors cost one round. Null ends are left out.
    """
    plain = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    both = cut(plain.unionByName(plain.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = cut(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        best = labels.join(seen, "node").select("node", "label", F.least("label", "near").alias("best"))
        hooked = best.groupBy("label").agg(F.min("best").alias("hook"))
        moved = best.join(hooked, "label").select("node", "label", F.least("best", "hook").alias("next"))
        ahead = labels.select(F.col("node").alias("next"), F.col("label").alias("ahead"))
        new = cut(moved.join(ahead, "next").select("node", F.col("label").alias("old"), F.least("next", "ahead").alias("label")), "labels")
        labels = new.select("node", "label")
        if new.where("label < old").isEmpty():
            return labels.withColumnRenamed("label", "component")
