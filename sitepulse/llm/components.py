"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitepulse.llm.common import look_up, stored


def _star(directed: DataFrame, total: int) -> DataFrame:
    """(u, v, least) for every neighbour v of u, where least is the smallest of u's neighbours.

    The smallest neighbour is aggregated (with a map-side part) and looked up, so the edges of a
    node with more than a thousandth of ``total`` edges stay where they are.
    """
    least = directed.groupBy("u").agg(F.min("v").alias("least"), F.count(F.lit(1)).alias("n"))
    return look_up(directed, least, "u", "n", total).drop("n")


def components(edges: DataFrame) -> DataFrame:
    """One row per node of ``edges`` (a, b): node, root (the smallest node of its component).

    Large-star and small-star steps alternate until the edge table stays the same; then it is a
    set of stars around the roots. Loops and repeated edges are allowed, nulls are not.
    """
    now = stored(edges.where("a != b").select(F.greatest("a", "b").alias("u"),
                                               F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast(
            "decimal(38,0)")).alias("h")).first()
        if state == seen or state["n"] == 0:
            break
        seen = state
        total = 2 * state["n"]
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, total).where("v > u").select(
            F.col("v").alias("u"), F.least("u", "least").alias("v"))
        large = stored(large.where("u != v").distinct(), "edges-large")
        small = _star(large, total)
        small = small.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(
            small.select("u", F.col("least").alias("v")))
        now = stored(small.where("u != v").distinct(), "edges")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
