"""Connected components by alternating star steps, as DataFrames with a written table after each round."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from zonewright.llm import storage

SAME_ROUNDS = 100


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a and b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, path: str) -> DataFrame:
    """(node, component) for each node of `edges` (a long, b long); component is the least node that links reach.

    Each round writes its edges below `path`, so a lost executor costs one round at most. A hub with many
    neighbours is reduced by partial minima; the join that follows is one that adaptive execution splits.
    Self-links keep their node in the result. An empty table gives an empty result.
    """
    alone = edges.where("a = b").select(F.col("a").alias("node")).distinct()
    now = storage.kept(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                       f"{path}/round=0")
    mark = F.struct(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"))
    seen = None
    for i in range(1, SAME_ROUNDS):
        now = storage.kept(_small_star(_large_star(now)), f"{path}/round={i}")
        found = now.select(mark.alias("s")).first()["s"]
        if found == seen:
            break
        seen = found
    else:
        raise RuntimeError("components did not settle")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    linked = stars.unionByName(roots)
    return linked.unionByName(alone.join(linked, "node", "left_anti").select("node", F.col("node").alias("component")))
