"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.session import discard, stage


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of the edges (a, b); the component is its least node.

    Alternates two steps until the edges are stars: every node hands its greater neighbours, then its smaller ones, to its
    least neighbour. Each round is staged as a table, so no lineage grows; rounds grow with the logarithm of the longest
    path. Minima are aggregated before they are joined, so a node of many edges meets no pairing of its neighbours.
    """
    current = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        both = current.select(F.col("high").alias("node"), F.col("low").alias("to")).unionByName(current.select(F.col("low").alias("node"), F.col("high").alias("to")))
        least = both.groupBy("node").agg(F.least(F.min("to"), F.first("node")).alias("least"))
        large = both.where("to > node").join(least, "node").select(F.col("to").alias("high"), F.col("least").alias("low"))
        large = large.where("high <> low").distinct()
        small_least = large.groupBy("high").agg(F.min("low").alias("least"))
        handed = large.join(small_least, "high")
        kept = handed.select("high", F.col("least").alias("low"))
        moved = handed.where("low <> least").select(F.col("low").alias("high"), F.col("least").alias("low"))
        old, current = current, stage(kept.unionByName(moved).distinct(), "edges")
        discard(old)  # of the rounds only the last is read again
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"no fixed point after {most_rounds} rounds")
    stars = current.select(F.col("high").alias("node"), F.col("low").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
