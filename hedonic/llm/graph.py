"""Connected components of an edge table by alternating large and small stars.

Every round points each node at the smallest neighbour it knows, first the larger
neighbours, then the smaller ones, until only stars around the smallest node of each
component are left; that takes about as many rounds as the logarithm of the longest path.
No node's neighbours are gathered: minima are pre-aggregated, and the joins that hand
them on may split a hot node. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hedonic.session import written


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with m, the smallest v of each u."""
    least = edges.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("m"))
    return edges.join(least, F.col("u") == F.col("_u")).drop("_u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    found = _with_least(both).filter("v > u")
    return found.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from the larger to the smaller node."""
    found = _with_least(edges)
    pairs = F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
    return found.select(pairs.alias("e")).select("e.u", "e.v").filter("u > v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Rows (u, v): every node of the edge table ``(u, v)`` that is not the smallest of its component, with that smallest node v."""
    edges = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct(), "edges")
    before = _state(edges)
    while before[0]:
        edges = written(_small_star(_large_star(edges)), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges
