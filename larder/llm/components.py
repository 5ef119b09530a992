"""Connected components of a table of links, by repeated large-star and small-star steps.

A large-star step links each node's larger neighbours to its smallest neighbour, a small-star step its smaller
ones; both keep the components and shorten paths, and after a logarithmic number of rounds every node points to
the smallest node of its component. Smallest neighbours are combined on the map side and written before they are
joined back, so a node with very many links is split by adaptive execution. Every step ends in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.shared import settled


def _nearest(links: DataFrame) -> DataFrame:
    return settled(links.groupBy("u").agg(F.least("u", F.min("v")).alias("low")), "nearest")


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v") % 1_000_003)).first())


def connected(links: DataFrame) -> DataFrame:
    """``links`` (a, b) to (node, component): every linked node and the smallest node that it reaches."""
    larger, smaller = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    links = settled(links.filter("a <> b").select(larger, smaller).distinct(), "links")
    state = _state(links)
    while True:
        both = links.union(links.select("v", "u"))
        large = both.filter("v > u").join(_nearest(both), "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = settled(large.filter("u > v").distinct(), "large-star")
        low = _nearest(large)
        small = large.join(low, "u").filter("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        links = settled(small.union(low.select("u", F.col("low").alias("v"))).distinct(), "small-star")
        before, state = state, _state(links)
        if state == before:
            break
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(links.select("v", "v").distinct())
