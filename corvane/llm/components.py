"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.skew import join_hot
from corvane.llm.store import discard, materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: neighbours (all larger ones, or all smaller ones) are hung on the smallest neighbour."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    count = edges.count()
    side = both if large else both.where("v < u")
    least = materialize(side.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count("*").alias("n")), "least")
    if large:
        out = join_hot(both.where("v > u"), least, ["u"], "v", 2 * count).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = join_hot(side, least, ["u"], "v", count).select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    out = materialize(out.where("u <> v").distinct(), "edges")
    discard(least)
    return out


def _unfinished(edges: DataFrame) -> bool:
    """Whether some id hangs on two others, or hangs on one that itself hangs on another."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("child"), F.lit(0).alias("parent"))
    ends = ends.union(edges.select(F.col("v").alias("id"), F.lit(0), F.lit(1)))
    roles = ends.groupBy("id").agg(F.sum("child").alias("child"), F.max("parent").alias("parent"))
    return not roles.where("child > 1 or child + parent > 1").isEmpty()


def connected_components(edges: DataFrame, rounds: int = 200) -> DataFrame:
    """``edges(u, v)`` -> ``(id, component)``: every id of an edge with the smallest id it can reach.

    Self-loops are ignored, repeated edges count once, null ends are dropped, an empty table gives an empty one.
    Each step is written to the shared folder; no edge passes through the driver. What is left unfinished after ``rounds`` rounds
    (their number grows with the logarithm of the longest path) is an error, never a wrong component.
    """
    now = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    now = materialize(now, "edges")
    left = rounds
    while _unfinished(now):
        if not left:
            raise RuntimeError(f"components are unfinished after {rounds} rounds")
        left -= 1
        large = _star(now, True)
        discard(now)
        now = _star(large, False)
        discard(large)
    stars = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return stars.union(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
