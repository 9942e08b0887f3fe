"""Connected components of a graph that is given by its links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _state(links: DataFrame) -> tuple:
    return links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``u, v``, whole numbers) but the roots: the smallest node that is reachable.

    Every round replaces links by links to smaller nodes, is written to the shared folder and keeps no more
    rows than there were links. Minima are combined before the shuffle and joined back, so that a node with
    very many links is split like any other skewed key. Takes a number of rounds that grows with the logarithm
    of the longest chain.
    """
    links = written(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    before, now = None, _state(links)
    while now != before:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = written(small.union(lowest.select("u", F.col("m").alias("v"))).distinct(), "links")
        before, now = now, _state(links)
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
