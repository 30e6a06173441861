"""Connected components of a link table, by alternating star contraction."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): for every node of ``links`` (a, b: long), the smallest node that it reaches.

    Each round makes every node point to the smallest node in its neighbourhood, first for the
    larger neighbours, then for the smaller ones; the number of rounds grows with the logarithm
    of the longest chain. Each round is written to the shared folder. Neighbourhood minima are
    hash aggregates (a hub's links collapse map-side); the join back is by a plain equi-join,
    which adaptive execution splits at a hub.
    """
    edges = stored(links.where(F.col("a") != F.col("b"))
                   .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    for _ in range(max_rounds):
        # larger neighbours of x move to the smallest neighbour of x (or x itself)
        both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(
            edges.select(F.col("v").alias("x"), F.col("u").alias("y")))
        low = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("m", "x").alias("m"))
        large = (both.where(F.col("y") > F.col("x")).join(low, "x")
                 .select(F.col("y").alias("u"), F.col("m").alias("v")).distinct())
        # x and its smaller neighbours move to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v")))
                 .where(F.col("u") != F.col("v")).distinct())
        after = stored(small, "links")
        # done when every node has one link and no root is a member of another star
        left = after.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count() or \
            after.select(F.col("v").alias("u")).join(after, "u", "left_semi").limit(1).count()
        edges = after
        if not left:
            break
    else:
        raise RuntimeError("components: not converged")
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
