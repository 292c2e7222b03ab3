"""Connected components of a link table by alternating stars, every round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Large star: neighbours above a node move to the smallest one around it.
    Small star: neighbours below a node, and the node, move to the smallest one.  The
    smallest comes from an aggregation that combines on the map side, so that a hub's links
    are not gathered anywhere."""
    around = _both_ways(links) if large else links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = around.join(least, "a")
    if large:
        return moved.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
    return (moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
            .filter("a <> b").distinct())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): component is the smallest node that can be reached."""
    links = written(links.filter("a <> b").select("a", "b").distinct(), "links")
    before = None
    while True:
        links = written(_star(_star(links, True), False), "stars")
        now = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    # Each node now hangs on its component's smallest node.
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
