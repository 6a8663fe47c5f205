"""Connected components of an edge table, by hooking to the least neighbour and halving paths.

A hub is a key of no join. Of a node with many edges there are as many copies of its label as shares of
HUB_EDGES, and each edge reads one of them; the least of what a hub's neighbours say is combined before
the shuffle. The label that a large component shares is joined by join_counted(), so that it is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from segmill.llm.common import copies_for, copy_numbers, copy_of, join_counted, stage, stage_groups

#: Edges that read one copy of a node's label, on average.
HUB_EDGES = 4096


def components(edges: DataFrame, hub_edges: int = HUB_EDGES) -> DataFrame:
    """(node, comp) for every node of edges(a, b); comp is the least node it reaches. An edge may be there twice.

    Each round is two joins on a node and a combined minimum; the number of rounds grows with the
    logarithm of the longest path. Labels are staged each round, so a lost executor costs one round.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).where("a <> b")
    nodes = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("comp"), F.count(F.lit(1)).alias("n"))
    labels, seen = stage_groups(nodes)
    copies = copies_for(F.col("n"), hub_edges)
    degrees = labels.select(F.col("node").alias("b"), "n")
    both = stage(join_counted(both, degrees, "b", seen=seen).select("a", "b", copy_of(F.col("a"), copies).alias("copy")))
    while True:
        told = labels.select(F.col("node").alias("b"), "comp", copy_numbers(copies).alias("copy"))
        near = both.join(told, ["b", "copy"]).groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        hooked = stage(labels.join(near, "node").select("node", "n", F.col("comp").alias("old"), F.least("comp", "near").alias("low")))
        tops = labels.select(F.col("node").alias("low"), F.col("comp").alias("top"))
        tops, seen = stage_groups(hooked.groupBy("low").agg(F.count(F.lit(1)).alias("n")).join(tops, "low"))
        found = Observation()
        moved = join_counted(hooked.withColumnRenamed("n", "own_n"), tops, "low", seen=seen).select("node", F.least("low", "top").alias("comp"), F.col("own_n").alias("n"), "old")
        labels = stage(moved.observe(found, F.count(F.when(F.col("comp") != F.col("old"), 1)).alias("moved")).drop("old"))
        if not found.get.get("moved"):
            return labels.drop("n")
