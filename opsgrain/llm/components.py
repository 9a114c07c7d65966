"""Connected components by alternating large-star and small-star rounds; every round is a few shuffles of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsgrain.session import drop_table, stage_table


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _both(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b"), F.col("a")))


def _star(pairs: DataFrame, larger: bool) -> DataFrame:
    """Hang the larger (or the smaller) neighbours of every node, and itself, on its smallest neighbour."""
    lowest = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    joined = pairs.join(lowest, F.col("u") == F.col("w"))
    if larger:
        out = joined.where("v > u").select(F.col("v").alias("b"), F.col("m").alias("a"))
    else:
        out = joined.select(F.explode(F.array("u", "v")).alias("b"), F.col("m").alias("a"))
    return out.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def roots(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a < b): the root is the smallest node of the component."""
    now, state = edges, _state(edges)
    while state[0]:
        large = _star(_both(now), larger=True)
        after = stage_table(_star(large.select(F.col("b").alias("u"), F.col("a").alias("v")), larger=False))
        new = _state(after)
        if now is not edges:
            drop_table(now)
        now = after
        if new == state:
            break
        state = new
    hung = now.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return hung.union(hung.select("root", "root").distinct())
