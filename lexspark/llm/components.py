"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.plans.lineage import cut_lineage


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first())


def connected(links: DataFrame) -> DataFrame:
    """(node, label): the least node of the component, for every node of ``links`` (a, b).

    Rounds of two steps: every node hands its least neighbour to its larger neighbours, then to its
    smaller ones, until each component is a star around its least node. A node's neighbours are
    never collected; a step is an aggregate and a join, whose large keys can be split. Each round is
    written to the shared folder, and the number of rounds grows with the logarithm of the longest
    path. NULL nodes and links of a node to itself are ignored.
    """
    now = cut_lineage(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = cut_lineage(both.where("b > a").join(least, "a").select(
            F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        now = cut_lineage(large.join(least, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select(F.col("e.a").alias("a"), F.col("e.b").alias("b")).where("a <> b").distinct())
        reached = _state(now)
        if reached == state:
            break
        state = reached
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        roots.select("node", F.col("node").alias("label")))
