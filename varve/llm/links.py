"""Connected components of a table of links, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varve.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, root): the least node that each node of ``links`` (a, b) is joined with.

    A node's neighbours are tied to the least of them, larger ones and smaller ones in turn, until
    every node is tied to its root. Groups are only aggregated, never gathered, so a large
    component costs no more in a task than its links dealt out; links of a node whose least
    neighbour is known already are combined before the shuffle. Every round is written to the
    shared folder, so a lost executor repeats one round. No link, no rows.
    """
    edges = materialize(links.select("a", "b").where("a <> b").distinct(), "links")
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root"))
        # Large star: ties each larger neighbour, and the node itself, to the least of the node's.
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("root").alias("b"))
        large = large.union(least.select("a", F.col("root").alias("b"))).where("a <> b").distinct()
        # Small star: ties smaller neighbours to the least of them.
        down = large.groupBy("a").agg(F.min("b").alias("root"))
        small = large.join(down, "a")
        small = small.select("b", "root").union(small.select(F.col("a").alias("b"), "root"))
        edges = materialize(small.where("b <> root").select(F.col("b").alias("a"), F.col("root").alias("b")).distinct(), "links")
        now = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("check")
        ).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
