"""Connected components of an undirected graph, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswright import workspace

#: Rounds after which the loop gives up; each at least halves the depth of the trees.
MAX_ROUNDS = 60


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_least(both), "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """``(v, component)`` for each vertex of ``edges`` (``u``, ``v``) that is not its component's least.

    Hubs are joined, never gathered; each round is written, so a lost executor repeats at
    most that round. Loops and repeated edges don't matter.
    """
    now = workspace.stage(edges.where("u <> v").select("u", "v").distinct(), "edges")
    before = None
    for _ in range(MAX_ROUNDS):
        sign = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if sign == before or not sign[0]:
            return now.select(F.col("u").alias("v"), F.col("v").alias("component"))
        before = sign
        now = workspace.stage(_small_star(_large_star(now).distinct()).distinct(), "edges")
    raise RuntimeError(f"components not found in {MAX_ROUNDS} rounds")
