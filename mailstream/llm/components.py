"""Connected components of an edge table, on Spark.

Each round every node takes the smallest label among its own and its
neighbours' labels, then the label of its label (pointer jumping). Labels
live in written tables; nothing but counts comes to the driver. Stars and
cliques settle in two or three rounds, a path of n nodes in about log(n).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailstream.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` -> ``(node, label)``: the smallest node reachable, for
    every node that has an edge. Empty edges give an empty result."""
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                   .filter("a <> b").distinct(), "cc-edges")
    labels = written(both.groupBy(F.col("a").alias("node"))
                     .agg(F.min("b").alias("m"))
                     .select("node", F.least("node", "m").alias("label")), "cc-labels")
    while True:
        near = written(both.join(labels, both["b"] == labels["node"])
                       .groupBy(F.col("a").alias("at")).agg(F.min("label").alias("near")), "cc-near")
        hooked = written(labels.join(near, labels["node"] == near["at"])
                         .select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")),
                         "cc-hooked")
        up = hooked.select(F.col("node").alias("root"), F.col("label").alias("up"))
        labels = written(hooked.join(up, hooked["label"] == up["root"], "left")
                         .select("node", F.least("label", F.coalesce("up", "label")).alias("label"),
                                 "old"), "cc-labels")
        if labels.filter("label <> old").limit(1).count() == 0:
            return labels.select("node", "label")
        labels = labels.select("node", "label")
