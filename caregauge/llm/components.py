"""Connected components of an edge list by alternating stars, as Spark joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caregauge.sources.scratch import stored


def _towards_minimum(edges: DataFrame, smaller_only: bool) -> DataFrame:
    """One star step. Every node hands its neighbours to the smallest one it knows.

    ``smaller_only``: a node hands over its smaller neighbours (small star), else its larger
    ones (large star). Both keep the components; ties and loops fall away.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if not smaller_only:
        both = both.union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    moved = both.join(least, "u")
    if smaller_only:
        pairs = moved.select(F.col("v").alias("x"), "m").union(moved.select(F.col("u").alias("x"), "m"))
    else:
        pairs = moved.where("v > u").select(F.col("v").alias("x"), "m")
    # a: the larger end, b: the smaller end
    return pairs.where("x <> m").select(F.col("x").alias("a"), F.col("m").alias("b")).distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root: the smallest node reached.

    Nodes that are their own root are left out. Every round is written to the shared scratch
    folder; the number of rounds grows with the logarithm of the longest path. No group is
    collected: a round is two aggregates with map-side combination and two joins by node, whose
    hot nodes Spark splits at run time.
    """
    current = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(),
        "links",
    )
    mark = None
    for _ in range(most_rounds):
        found = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if (found[0], found[1]) == mark:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = (found[0], found[1])
        current = stored(_towards_minimum(_towards_minimum(current, False), True), "links")
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
