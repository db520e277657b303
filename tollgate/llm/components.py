"""Connected components of an edge table, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.common import stored


def thinned(edges: DataFrame) -> DataFrame:
    """(a, b) with a <= b: edges that connect what `edges` (a, b) connect, mostly one per node.

    A node keeps the edge to its least neighbour; those to its other smaller neighbours move down, between them and the least. Nodes
    that many groups join to different nodes thus keep one edge each. No round adds edges; rounds go on while they save a tenth.
    """
    found = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    n = found.count()
    while True:
        least = found.withColumn("least", F.min("a").over(Window.partitionBy("b")))
        kept = F.col("a") == F.col("least")
        moved = least.select(F.col("least").alias("a"), F.when(kept, F.col("b")).otherwise(F.col("a")).alias("b"))
        found, before = stored(moved.distinct(), "edges"), n
        n = found.count()
        if 10 * n >= 9 * before:
            return found


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b); root is the component's smallest node.

    The edges are thinned first, so that the joins go over about one edge per node, not over one per node and group it is in.
    Each round a node takes the least root among its neighbours, offers it to its own root as well, and then skips to
    its root's root. Trees merge and halve their depth, so rounds grow with the logarithm of the longest path. Every
    round is a table in the shared folder.
    """
    few = thinned(edges)
    both = stored(few.select("a", "b").union(few.select("b", "a")).distinct(), "edges")
    roots = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")), "roots")
    while True:
        seen = both.join(roots.withColumnsRenamed({"node": "b", "root": "near"}), "b")
        least = seen.groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        hooked = roots.join(least, "node")
        offers = hooked.groupBy(F.col("root").alias("node")).agg(F.min("near").alias("offer"))
        taken = hooked.join(offers, "node", "left").select("node", F.least("root", "near", "offer").alias("next"), F.col("root").alias("old"))
        targets = taken.select(F.col("node").alias("next"), F.col("next").alias("far"))
        moved = stored(taken.join(targets, "next").select("node", F.least("next", "far").alias("root"), "old"), "roots")
        roots = moved.select("node", "root")
        if moved.filter("root <> old").isEmpty():
            return roots
