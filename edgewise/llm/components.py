"""Connected components of an edge table by alternating stars, as joins and aggregates.

Every round joins each edge with the smallest neighbour of its ends; no
neighbour list is gathered anywhere, and a round's edges are written to the
shared folder so that lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgewise.llm.common import dropped, stored


def _least_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("a").alias("c")).agg(F.min("b").alias("m")).select("c", F.least("c", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the node's smallest neighbour."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.join(_least_neighbour(both), both["a"] == F.col("c")).where(F.col("b") > F.col("a")) \
        .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    near = down.join(_least_neighbour(down), down["a"] == F.col("c"))
    return near.select(F.col("b").alias("a"), F.col("m").alias("b")) \
        .unionAll(near.select("a", F.col("m").alias("b"))).where(F.col("a") != F.col("b")).distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): every node of ``edges`` (a, b) with the smallest node it reaches.

    Edges with a null end are dropped; self-loops alone make no component.
    An empty table gives an empty table.
    """
    now = stored(edges.select("a", "b").where(F.col("a") != F.col("b"))
                 .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        new = stored(_small_star(_large_star(now)), "edges")
        dropped(now)
        now, before, state = new, state, _state(new)
        if state == before:
            break
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
