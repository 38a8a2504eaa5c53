"""Connected components of a link table on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(links: DataFrame) -> DataFrame:
    """node, component: the smallest node that each node of ``links`` (a, b) reaches.

    Alternating large and small stars: every round hangs each node's neighbours on the least of them, which
    keeps the components and never makes more edges than there were; the rounds end when all edges are stars,
    after about as many rounds as the logarithm of the longest chain. Every round is written, so nothing is
    recomputed; the driver sees two counts a round.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = materialize(edges, "edges")
    before = None
    while True:
        # Large star: larger neighbours go to the least neighbour, or to the node itself.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: a node and its smaller neighbours go to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u")
        small = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = materialize(small.where("u <> v").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before == now:
            break
        before = now
    stars = edges.groupBy("u").agg(F.min("v").alias("v"))
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
