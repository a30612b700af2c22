"""Connected components of a graph of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashline.llm.common import settled


def _stars(links: DataFrame, both_ways: bool) -> DataFrame:
    """Links (a, b), a > b, with neighbours moved to the least node around."""
    if both_ways:
        around = links.union(links.select("b", "a").toDF("a", "b"))
    else:
        around = links
    least = settled(around.groupBy("a").agg(F.min("b").alias("least")), "least")
    if both_ways:
        least = least.withColumn("least", F.least("a", "least"))
        moved = around.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = around.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        moved = moved.union(least)
    return settled(moved.filter("a != b").distinct(), "stars")


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (a, b) but the components themselves: their least nodes.

    Every step is written to the shared folder. A node with many links is summed before it is shuffled,
    and its links are joined as a skewed join. Links of a node to itself are ignored.
    """
    now = links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = settled(now, "links")
    while not _finished(now):
        now = _stars(_stars(now, True), False)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _finished(links: DataFrame) -> bool:
    """Whether every node but the centres has one link, and that to a centre."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("centre")).union(
        links.select("b", F.lit(0), F.lit(1))
    )
    each = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("centre").alias("centre"))
    return each.filter("out + centre > 1").isEmpty()
