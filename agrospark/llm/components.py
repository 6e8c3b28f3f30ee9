"""Connected components of a graph whose nodes have few neighbours each, by min-label rounds with jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrospark.llm.common import lookup, written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root``: root is the smallest node reachable, for every node of ``links`` (undirected, written).

    A round takes the least label among a node and its neighbours, then replaces each label by the label
    of the node it names, so that paths shorten fast. A label may be shared by a third of all nodes; that
    join goes through ``lookup``. Rounds end when no label changes; each is written to the shared folder.
    """
    edges = written(links.select(F.col(a).alias("node"), F.col(b).alias("other"))
                    .unionByName(links.select(F.col(b).alias("node"), F.col(a).alias("other"))).distinct(), "edges")
    labels = written(edges.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("root")), "labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("other"), "root"), "other").groupBy("node").agg(F.min("root").alias("m"))
        step = written(labels.join(near, "node").select("node", F.least("root", "m").alias("root"), F.col("root").alias("was")), "labels-near")
        named = step.groupBy("root").agg(F.count("*").alias("w"))
        jump = written(named.join(step.select(F.col("node").alias("root"), F.col("root").alias("to")), "root"), "labels-jump")
        new = written(lookup(step, jump, ["root"], "w", ["node"]).select(
            "node", F.least("root", F.coalesce("to", "root")).alias("root"), "was"), "labels")
        changed = new.filter("root <> was").limit(1).count()
        labels = new.select("node", "root")
        if not changed:
            return labels
