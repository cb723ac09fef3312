"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept

MAX_ROUNDS = 60


def connected_components(links: DataFrame) -> DataFrame:
    """Links ``a, b`` (long) to ``node, component`` with the smallest node of each component.

    Every round points the neighbours of a node to the smallest one: first the
    larger neighbours (large star), then the smaller ones (small star). The number
    of rounds grows with the logarithm of the number of nodes. Minima are taken
    map-side, so a node with very many links stays cheap. Nodes without links do
    not occur in the result.
    """
    edges = kept(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    for _ in range(MAX_ROUNDS):
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(
            least.select("u", F.col("m").alias("v"))).distinct()
        edges = kept(small, "stars")
        # Equal sums of hashes: the set of edges did not change.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    else:
        raise ValueError("the components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct())
