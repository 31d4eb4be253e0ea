"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.session import written


def _directed(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger end `u` to its smaller end `v`."""
    return (
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least one of its neighbourhood."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("low"))
    least = least.select("u", F.least("u", "low").alias("low"))
    return (
        both.join(least, "u")
        .where("v > u")
        .select(F.col("v").alias("u"), F.col("low").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("low"))
    others = (
        edges.join(least, "u")
        .where("v <> low")
        .select(F.col("v").alias("u"), F.col("low").alias("v"))
    )
    return others.union(least.select("u", F.col("low").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b); component is its least node.

    The rounds grow with the logarithm of the longest chain. Each round is written to the
    shared folder, so that a lost executor costs one round, and a star with any number of
    leaves is a join that adaptive execution can split. Edges from a node to itself, repeated
    edges and an empty table are allowed; a node that only has an edge to itself is left out.
    """
    current = written(_directed(edges), "edges")
    state = _state(current)
    while state[0]:
        current = written(_small_star(_large_star(current)), "stars")
        before, state = state, _state(current)
        if state == before:
            break
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        current.select(F.col("v"), F.col("v")).distinct()
    )
