"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.sources.tables import checkpointed


def _to_smallest(links: DataFrame, centre: str, other: str) -> DataFrame:
    """Links ``u``-``v`` with ``m``, the smallest of all neighbours of ``u`` and ``u`` itself.

    The minimum combines before the shuffle, and the join has a shuffle on either side, so that a node
    with many links is split over tasks.
    """
    links = links.select(F.col(centre).alias("u"), F.col(other).alias("v"))
    smallest = checkpointed(links.groupBy("u").agg(F.min("v").alias("m")))
    return links.join(smallest, "u").select("u", "v", F.least("u", "m").alias("m"))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected with, for each node in links ``a``-``b``.

    Alternates the two star operations: every node links its larger neighbours to its smallest one, then
    its smaller neighbours and itself. Links turn into stars around the smallest node in a number of
    rounds that grows with the logarithm of the longest path. Each round is written to the shared folder.
    NULLs and links of a node with itself must not be there.
    """
    links = checkpointed(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while (state := links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20, 0)"))).first()) != before:
        before = state
        both = links.union(links.select("b", "a"))
        large = _to_smallest(both, "a", "b").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = checkpointed(large.distinct())
        stars = _to_smallest(large, "a", "b")
        small = stars.filter("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        small = small.union(stars.select("u", "m"))
        links = checkpointed(small.distinct())
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select(F.col("b"), F.col("b")).distinct()
    )
