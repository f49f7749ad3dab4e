"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyglass.session import durable


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung under the node's smallest neighbour (or the node)."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Cut from its plan, so that the join shuffles both sides itself and a hot node can be split over tasks.
    least = durable(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least")))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are hung under the smallest of them. Edges lead from large to small."""
    least = durable(edges.groupBy("a").agg(F.min("b").alias("least")))
    moved = edges.join(least, "a")
    return (
        moved.where("b <> least")
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .unionByName(least.select("a", F.col("least").alias("b")))
        .distinct()
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)`` but the roots themselves; root: the smallest node of its component.

    Rounds end when a star forest no longer changes, after about the logarithm of the longest path. Hot nodes are aggregated before
    they are joined. Each round is checkpointed, so that a lost executor repeats one round at most.
    """
    now = durable(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    state = _state(now)
    while state[0]:
        now = durable(_small_star(_large_star(now)))
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
