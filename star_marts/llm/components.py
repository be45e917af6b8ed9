"""Connected components of a graph given by its links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from star_marts.session import stage


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the least node around: the larger ones, or the smaller ones and itself."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sides = both if large else both.filter("b < a")
    least = sides.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = sides.join(least, "a")
    if large:
        hung = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        hung = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return hung.filter("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """`links` (a, b) of longs to (node, root): the least node of each component, for linked nodes.

    Every round is stored; rounds grow with the logarithm of the longest chain.  The end is seen
    by two sums over the links, of which nothing else reaches the driver.
    """
    links = stage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "links")
    seen = None
    while True:
        links = stage(_stars(_stars(links, True), False), "links")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        seen = state
