"""Connected components of an edge table, by contraction rounds in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ionloom.llm.common import materialize


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b: long); nodes share a label just if edges connect them.

    A round points every node at its smallest neighbour, shortens those pointers once, and replaces the ends of the edges
    by what they point at; edges within one node go. Each round leaves at most half of the nodes, and every table of a
    round is a written one, so that lost executors cost no round and Spark can split the edges of a hub. Self-loops and
    repeated edges do no harm; no edges give no rows.
    """
    cut = materialize(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc-edges")
    levels: list[DataFrame] = []
    for _ in range(max_rounds):
        if cut.isEmpty():
            break
        both = cut.select("a", "b").union(cut.select("b", "a"))
        near = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("to"))
        near = materialize(near, "cc-near")
        hop = near.select(F.col("node").alias("mid"), F.col("to").alias("end"))
        level = materialize(near.join(hop, near["to"] == hop["mid"], "left").select("node", F.least("to", F.coalesce("end", "to")).alias("to")), "cc-level")
        levels.append(level)
        left = level.select(F.col("node").alias("a"), F.col("to").alias("a_to"))
        right = level.select(F.col("node").alias("b"), F.col("to").alias("b_to"))
        ends = cut.join(left, "a").join(right, "b").select(F.greatest("a_to", "b_to").alias("a"), F.least("a_to", "b_to").alias("b"))
        cut = materialize(ends.where(F.col("a") != F.col("b")).distinct(), "cc-edges")
    else:
        raise RuntimeError("the contraction did not end")
    if not levels:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).limit(0)
    labels = levels[0].select("node", F.col("to").alias("label"))
    for level in levels[1:]:
        step = level.select(F.col("node").alias("from"), "to")
        labels = labels.join(step, labels["label"] == step["from"], "left").select("node", F.coalesce("to", "label").alias("label"))
    return materialize(labels, "cc-labels")
