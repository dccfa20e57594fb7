"""Connected components of a graph held in a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.plans.workspace import materialize

# Links shrink to stars in a number of rounds that is about the logarithm of
# the longest chain; a graph that needs more than this many is a fault.
MOST_ROUNDS = 100


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``, ``root`` being the
    smallest node that it is connected to. Loops and repeats do no harm.

    Two steps take turns until nothing moves. Larger neighbours of a node are
    hung on its smallest neighbour; then a node and its smaller neighbours are
    hung on the smallest of them. Every table has at most one row per link and
    minima are taken on the map side, so a node with a third of all links is no
    bottleneck. Each round is written to the shared folder.
    """
    links = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi > lo")
    links = materialize(links.distinct(), "links")
    before = None
    for _ in range(MOST_ROUNDS):
        links = materialize(_smaller(_larger(links)), "links")
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())
        if now == before:
            return links.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
                links.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
            )
        before = now
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")


def _both(links: DataFrame) -> DataFrame:
    turned = links.select(F.col("lo").alias("node"), F.col("hi").alias("other"))
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("other")).union(turned)


def _larger(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node, hung on the smallest of the node and
    its neighbours."""
    both = _both(links)
    least = both.groupBy("node").agg(F.least("node", F.min("other")).alias("least"))
    above = both.filter("other > node").join(least, "node")
    return above.select(F.col("other").alias("hi"), F.col("least").alias("lo")).distinct()


def _smaller(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours, hung on the smallest of them."""
    least = links.groupBy("hi").agg(F.min("lo").alias("least"))
    hung = links.join(least, "hi").filter("lo > least").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
    return hung.union(least.select("hi", F.col("least").alias("lo"))).distinct()
