"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from circulation.llm.common import written

MAX_STEPS = 60


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    sym = _both_ways(edges)
    least = sym.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return sym.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, root) for every node of the edges (a, b), its own root included: root is the least reachable.

    Each step is written to the shared scratch folder; the work stops when a step changes no edge.
    Nodes that a hub with very many edges holds are reached through partial minima and a join that
    adaptive execution can split, never in one group.
    """
    state = written(edges.where("a != b").distinct(), label)
    seen = None
    for step in range(MAX_STEPS):
        mark = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
        state = written(_small_star(_large_star(state)).distinct(), f"{label}-{step}")
    else:
        raise RuntimeError("components did not settle")
    return state.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        state.select("b", "b").distinct())
