"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsluice.llm.shared import stored


def components(links: DataFrame) -> DataFrame:
    """``node``, ``label``: the smallest node of the component of every linked node.

    ``links`` has two integer columns ``a`` and ``b``. Rounds of star contraction: every node
    hands its larger neighbours to its smallest one, then its smaller ones. A round keeps the
    number of links at most and is written to the shared folder; the number of rounds grows with
    the logarithm of the longest path. NULL ends, loops and repeated links have no effect.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links = stored(links, "links")
    while not _is_contracted(links):
        links = stored(_small_star(_large_star(links)), "links")
    stars = links.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return stars.unionByName(stars.select(F.col("label").alias("node"), "label").distinct())


def _is_contracted(links: DataFrame) -> bool:
    """Whether every node has one link at most to a smaller one, which has none itself."""
    linked = links.groupBy("u").agg(F.count("*").alias("n"))
    inner = links.select(F.col("v").alias("u")).join(linked, "u", "left_semi")
    return linked.where("n > 1").select("u").unionByName(inner).isEmpty()


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = both.where("v > u").join(least, "u")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
