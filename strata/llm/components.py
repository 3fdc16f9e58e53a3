"""Connected components by contraction, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import keep_table


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``edges(a, b)``; the label is the
    smallest node reachable.  Each round every node points at its smallest
    neighbour, pointers are followed twice, and the edges are rewritten between
    the nodes pointed at, so the number of live nodes at least halves.  Self
    edges and repeated edges are harmless; no edges give no rows."""
    live = keep_table(edges.select("a", "b").where("a <> b").distinct(), "edges")
    labels = None
    while labels is None or not live.isEmpty():
        both = live.union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy("a").agg(F.min("b").alias("p")).select(F.col("a").alias("n"), F.least("a", "p").alias("p"))
        for _ in range(2):
            over = up.select(F.col("n").alias("p"), F.col("p").alias("pp"))
            up = up.join(over, "p", "left").select("n", F.coalesce("pp", "p").alias("p"))
            up = keep_table(up, "pointers")
        if labels is None:
            labels = up.select(F.col("n").alias("node"), F.col("p").alias("label"))
        else:
            labels = (labels.join(up.withColumnRenamed("n", "label"), "label", "left")
                      .select("node", F.coalesce("p", "label").alias("label")))
        labels = keep_table(labels, "labels")
        live = (live.join(up.select(F.col("n").alias("a"), F.col("p").alias("pa")), "a", "left")
                .join(up.select(F.col("n").alias("b"), F.col("p").alias("pb")), "b", "left")
                .select(F.coalesce("pa", "a").alias("a"), F.coalesce("pb", "b").alias("b"))
                .where("a <> b").distinct())
        live = keep_table(live, "edges")
    return labels
