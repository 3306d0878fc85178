"""Connected components of an edge list by alternating star contractions.

Every round is two aggregations and two joins on the edge list, so no
component and no neighbour list is ever gathered in one task or the driver; the
number of rounds grows with the logarithm of the longest path."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import cut


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``edges`` (two columns of one ordered type) to ``(node, root)``: root is
    the smallest node reachable. Nodes without an edge do not appear."""
    e = cut(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
            .where("a is not null and b is not null and a <> b").distinct())
    mark = _mark(e)
    for _ in range(max_rounds):
        if mark[0] == 0:
            break
        e = cut(_small_star(_large_star(e)))
        mark, last = _mark(e), mark
        if mark == last:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select("b", "b").distinct())


def _mark(e: DataFrame) -> tuple:
    h = F.xxhash64("a", "b")
    return tuple(e.agg(F.count("*"), F.bit_xor(h), F.sum(h.cast("decimal(38,0)"))).first())


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select("b", "a"))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("a").agg(F.min("b").alias("m"))
    rest = e.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.union(low.select("a", "m")).distinct()
