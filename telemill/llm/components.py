"""Connected components of an edge list, by alternating star contractions.

Each step takes the smallest neighbour of every node with combining before the
shuffle and joins it back, so a node with very many neighbours is never one
task's list. Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def _least(edges: DataFrame, node: str, other: str) -> DataFrame:
    return edges.groupBy(node).agg(F.least(F.min(other), F.col(node)).alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to its smallest one."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.join(_least(both, "a", "b"), "a").filter("b > a").select(
        F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them; edges run from the larger end ``a``."""
    near = edges.join(_least(edges, "a", "b"), "a")
    return near.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
        near.select("a", F.col("least").alias("b"))).filter("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(key, component) of every node of ``edges`` (columns a, b); the component is its smallest node."""
    now = stored(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                 "edges")
    seen = None
    while True:
        # order-free mark of the edge set: equal before and after means stars only
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()
        if mark == seen:
            break
        seen = mark
        now = stored(_small_star(stored(_large_star(now), "edges")), "edges")
    return now.select(F.col("a").alias("key"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("key"), F.col("b").alias("component")).distinct())
