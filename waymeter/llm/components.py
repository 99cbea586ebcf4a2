"""Connected components of links, by alternating stars; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymeter.llm.shared import written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Links every neighbour that is larger (`large`) or not (small) to the least id seen from a node.

    Minima are partial per task, and the join with them is one that AQE splits where a node is hot.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        made = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        # a > b in every row, so a node's neighbours here are all smaller than it.
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        made = both.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return made.where("a <> b").distinct()


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (a, b): component is the least id reachable.

    Rounds follow the logarithm of the longest path. Each is written to the shared folder, so the plan does not
    grow and a lost executor repeats one round. Links to oneself and repeated links are harmless; rows with a
    null end are left out.
    """
    edges = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = _digest(edges)
    while before[0]:
        edges = written(_stars(_stars(edges, large=True), large=False), "links")
        after = _digest(edges)
        if after == before:
            break
        before = after
    # Now every component is a star around its least node.
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
