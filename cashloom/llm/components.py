"""Connected components of a stored list of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import Staging


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and component (the smallest node it reaches) of every node that a link names.

    Links with a missing end and links of a node to itself say nothing. Each round first ties
    every node's larger neighbours to its smallest one and then its smaller neighbours, which
    shortens paths at least by half in practice; the loop ends when all links are stars around
    smallest nodes. A node with very many links only ever meets them in aggregations that
    combine before the shuffle and in joins that can be split. The links of a round are released
    when the next one has its own.
    """
    clean = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    round_ = Staging(links.sparkSession)
    current = round_(clean.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct())
    while not _are_stars(current):
        both = current.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            current.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(lowest, "hi").where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        before, round_ = round_, Staging(links.sparkSession)
        current = round_(small.unionByName(lowest.select("hi", F.col("m").alias("lo"))).distinct())
        before.release()
    roots = current.select(F.col("lo").alias("node")).distinct().withColumn("component", F.col("node"))
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots)


def _are_stars(links: DataFrame) -> bool:
    """Whether every larger end has one link and no smaller end is itself a larger end."""
    ends = links.groupBy(F.col("hi").alias("node")).agg(F.count(F.lit(1)).alias("up"))
    roots = links.select(F.col("lo").alias("node")).distinct().withColumn("root", F.lit(1))
    return not ends.join(roots, "node", "left").where("up > 1 or root = 1").limit(1).count()
