"""Connected components of links, by joins of links with the smallest neighbour of each node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.scratch import Workspace


def connected(links: DataFrame, work: Workspace, label: str) -> DataFrame:
    """``node, component`` of all nodes of ``links (a, b)``; a component's id is its smallest node.

    Alternates two steps until nothing changes: each node hands its larger neighbours to the
    smallest one (large star), then its smaller neighbours and itself (small star). The rounds
    grow with the logarithm of the longest path. Smallest neighbours are combined on the map
    side; the links of one node meet its smallest neighbour in one task, so that a node with very
    many links makes a long one.
    """
    edges = links.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
    edges = work.table(edges.where("lo < hi").distinct(), f"{label}-0")
    before, i = _signature(edges), 0
    while True:
        i += 1
        after = _small_star(_large_star(edges))
        edges = work.table(after, f"{label}-{i}")
        work.drop(f"{label}-{i - 1}")
        now = _signature(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots)


def _signature(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count("*"), F.sum(F.xxhash64("lo", "hi").bitwiseAND(0xFFFFFFFF)), F.sum(F.xxhash64("hi", "lo") % 1000003)
        ).first()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionByName(
        edges.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
    )
    smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    larger = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    return larger.join(smallest, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    smallest = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(smallest, "hi").where("lo <> m").select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
    return moved.unionByName(smallest.select(F.col("m").alias("lo"), "hi")).distinct()
