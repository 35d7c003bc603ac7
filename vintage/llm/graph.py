"""Connected components of an edge table, by repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintage.llm.common import dropped, written

#: Far more rounds than needed (they grow as the logarithm of a component's size).
ROUNDS = 60


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an
    edge. Rounds alternate: every node's larger neighbours move to its
    smallest neighbour, then every node's smaller ones do; both are one
    shuffle on the node, and stars remain. Loops and repeated edges are
    harmless; no edges give an empty table."""
    current = written(edges.select(F.least(a, b).alias("v"), F.greatest(a, b).alias("u")).filter("u <> v").distinct())
    for _ in range(ROUNDS):
        both = current.select("u", "v").union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        after = written(small.select("e.u", "e.v").filter("u <> v").distinct())
        # a forest of stars: nobody is both a member and a centre, and every
        # member has one centre
        loose = after.groupBy("u").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count() \
            or after.join(after.select(F.col("v").alias("u")).distinct(), "u", "left_semi").limit(1).count()
        dropped(current)
        current = after
        if not loose:
            break
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
