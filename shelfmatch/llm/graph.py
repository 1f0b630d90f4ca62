"""Connected components of a graph that is given as edges between longs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmatch.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node of ``edges`` (columns a, b).

    Alternating large and small stars: each round hangs a node's larger neighbours, then its smaller ones, on its
    smallest neighbour.  Edges never outnumber the input's, a hub is a key of partial minima and of a join that
    Spark can split, and each round's edges are written to the shared folder, so a lost executor costs one round.
    """
    edges = stored(_canonical(edges), "edges")
    while True:
        after = stored(_canonical(_small_star(_large_star(edges))), "edges")
        before, edges = edges, after
        if _print(before) == _print(after):
            break
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()


def _print(edges: DataFrame) -> tuple:
    """Count and order-free hash of distinct edges."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a", F.lit(1)))).first())


def _canonical(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang each node's larger neighbours on the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang each node and its smaller neighbours on the smallest of them."""
    edges = _canonical(edges)
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    hung = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return hung.unionByName(least.select("a", F.col("m").alias("b")))
