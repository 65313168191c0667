"""Connected components of an edge table, as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsim.llm.common import drop, split_join, store

MAX_ROUNDS = 60


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of ``edges``, stored: the smallest
    node that links reach.  Alternating large-star and small-star rounds; every
    round is written to the shared folder, so no lineage grows and a lost
    executor costs one round.  Aggregations combine before they shuffle, so
    a hub with a third of all edges is one row per task.
    """
    cur = store(edges.filter(F.col(a) != F.col(b))
                     .select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct(), "edges")
    both = lambda e: e.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(
        e.select(F.col("v").alias("x"), F.col("u").alias("y")))
    for _ in range(MAX_ROUNDS):
        # large star: neighbours above x move to the least of x and its neighbours
        e = both(cur)
        least = e.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("m"), F.count("*").alias("n"))
        large = (split_join(e, least, "x", "n", 2 * cur.count(), "inner", F.xxhash64("y"))
                 .filter(F.col("y") > F.col("x"))
                 .select(F.col("m").alias("u"), F.col("y").alias("v")).distinct())
        large = store(large, "large-star")
        drop(cur)
        # small star: a node's smaller neighbours and itself move to the least of them
        low = large.groupBy("v").agg(F.min("u").alias("m"), F.count("*").alias("n"))
        moved = split_join(large, low, "v", "n", large.count(), "inner", F.xxhash64("u"))
        small = (moved.select(F.col("m").alias("u"), F.col("u").alias("v"))
                      .unionByName(low.select(F.col("m").alias("u"), "v"))
                      .filter(F.col("u") != F.col("v")).distinct())
        nxt = store(small, "small-star")
        drop(large)
        # done when every node has one smaller neighbour and that is a root
        roots = nxt.select(F.col("u").alias("r")).distinct().join(nxt.select("v").distinct(), F.col("r") == F.col("v"), "left_semi")
        twice = nxt.groupBy("v").agg(F.count("*").alias("n")).filter("n > 1")
        cur = nxt
        if roots.isEmpty() and twice.isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    top = cur.select(F.col("u").alias("node")).distinct().withColumn("component", F.col("node"))
    out = store(cur.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(top), "components")
    drop(cur)
    return out
