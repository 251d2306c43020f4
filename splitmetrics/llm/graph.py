"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitmetrics.sources.workspace import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """For each node of ``edges(a, b)`` (longs) the smallest node it is connected to.

    Returns ``node, root``, without the roots themselves. Every round hangs a node's
    neighbours below the smallest of them, first the larger ones, then the smaller; the number of rounds
    grows with the logarithm of the longest path. Each round is written to the shared folder, so
    a lost executor repeats one round at most. A node with very many neighbours is one key of
    a join of two tables, which Spark splits, and of a minimum that is formed before the shuffle.
    """
    current, state = _staged(edges.where("a != b").selectExpr("greatest(a, b) as a", "least(a, b) as b"))
    while state[0]:
        following, reached = _staged(_small_star(stage(_large_star(current), "large_star")))
        if reached == state:
            break
        current, state = following, reached
    return current.selectExpr("a as node", "b as root")


def _staged(edges: DataFrame) -> tuple[DataFrame, tuple]:
    kept = stage(edges.distinct(), "components")
    return kept, tuple(
        kept.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b").cast("decimal(38,0)"))).first()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.selectExpr("b as a", "a as b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a", "least(a, m) as m")
    least = stage(least, "least_neighbours")
    return both.where("b > a").join(least, "a").selectExpr("b as a", "m as b")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.where("a != b").selectExpr("greatest(a, b) as a", "least(a, b) as b")
    least = stage(down.groupBy("a").agg(F.min("b").alias("m")), "least_neighbours")
    moved = down.join(least, "a").where("b != m").selectExpr("b as a", "m as b")
    return moved.union(least.selectExpr("a", "m as b"))
