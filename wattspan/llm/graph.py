"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise


def _least(edges: DataFrame) -> DataFrame:
    """(u, m): least neighbour of u, itself included. Combined before the shuffle, so hubs don't gather."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, one: str, other: str) -> DataFrame:
    """(u, root) for every end of an edge: root is the least end that can be reached.

    Ends are longs. Loops and repeated edges are allowed, NULL ends are dropped. Every round is written
    to the shared folder; rounds go on until a round changes nothing.
    """
    plain = edges.select(F.greatest(one, other).alias("u"), F.least(one, other).alias("v"))
    current = materialise(plain.where("u > v").distinct(), "components")
    before = _signature(current)
    while before[0]:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.where("v > u").join(_least(both), "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct())
        down = large.join(_least(large), "u")
        small = (down.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                               F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.*").where("u > v").distinct())
        current = materialise(small, "components")
        after = _signature(current)
        if after == before:
            break
        before = after
    roots = current.select("v").distinct()
    return current.select("u", F.col("v").alias("root")).union(roots.select("v", "v"))
