"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rivulet.llm.common import settle


def _directed(edges: DataFrame) -> DataFrame:
    """Each link once, from the larger to the smaller node."""
    return (edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .where("a <> b").distinct())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b): the smallest node reachable.

    Each round hooks every neighbour to the smallest node around it, first looking
    upwards, then downwards; trees flatten in a logarithmic number of rounds. The
    minimum per node is taken before the shuffle and joined back, so a hub with
    many links is never gathered in one group. Rounds are cut by written tables.
    Links with a NULL end are ignored; an empty table gives an empty table.
    """
    now = settle(_directed(edges.where("a IS NOT NULL AND b IS NOT NULL")), "links")
    mark = None
    while True:
        seen = now.agg(F.count("*").alias("n"),
                       F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if (seen["n"], seen["s"]) == mark or not seen["n"]:
            break
        mark = (seen["n"], seen["s"])
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(
            F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a")
        now = settle(_directed(small.select("b", F.col("m").alias("a")).union(
            lowest.select(F.col("m").alias("b"), "a").select("b", "a"))), "links")
    return (now.groupBy("a").agg(F.min("b").alias("component"))
            .select(F.col("a").alias("node"), "component")
            .union(now.select("b", "b").distinct()))
