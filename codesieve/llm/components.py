"""Connected components of an edge table by alternating large-star and small-star."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesieve.llm.common import durable
from codesieve.operators.partitioning import join_wide

#: Edges of a partition: tasks, each of which the driver keeps account of, grow with the edges and not with the plan.
EDGES = 4096


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31)))).first())


def _parts(edges: int) -> int:
    """Partitions of so many edges; coalescing to them never makes more than there are."""
    return max(1, math.ceil(edges / EDGES))


def _with_smallest(edges: DataFrame, parts: int) -> DataFrame:
    """``u``, ``v`` and ``m``, the smallest of u and all v of that u; a node may hold much of the edges."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("m")).coalesce(parts)
    return join_wide(edges, smallest, "u").coalesce(parts).withColumn("m", F.least("u", "m"))


def _large_star(edges: DataFrame, parts: int) -> DataFrame:
    """Every neighbour larger than a node is tied to the smallest of its neighbourhood."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_smallest(both, parts).where("v > u and v <> m").select(
        F.col("v").alias("u"), F.col("m").alias("v")).distinct().coalesce(parts)


def _small_star(edges: DataFrame, parts: int) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them; edges lead from large to small."""
    tied = _with_smallest(edges, parts)
    neighbours = tied.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = tied.where("u <> m").select("u", F.col("m").alias("v"))
    return neighbours.union(own).distinct().coalesce(parts)


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node``, ``component``: the smallest node it can reach.  ``edges``: two columns of ids, in any direction.

    Only nodes with an edge to another node are returned.  Null ends, loops and repeated edges are ignored.  Each
    round works on edges alone, is checkpointed, and no node's neighbours are ever brought together.  Nothing is sent
    to all tasks, and a round has as many tasks a step as its edges fill partitions of ``EDGES``.
    """
    a, b = edges.columns
    edges = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = durable(edges)
    state = _state(edges)
    edges = edges.coalesce(_parts(state[0]))
    for _ in range(most_rounds):
        if not state[0]:
            break
        parts = _parts(state[0])
        edges = durable(_small_star(_large_star(edges, parts), parts))
        before, state = state, _state(edges)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.union(roots.coalesce(_parts(state[0])))
