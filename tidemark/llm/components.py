"""Connected components of a link table, by repeated star contraction in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import kept

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` to ``(node, root)``: root is the smallest node reachable.

    Each round hangs larger neighbours of every node on its smallest one, then smaller ones;
    the links shrink to stars in a logarithmic number of rounds. Minima are combined before
    the shuffle; nodes with many links meet in plain joins, which adaptive execution splits.
    Links with a null end and self-links are ignored. Each round is stored, not cached.
    """
    edges = kept(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    state = _state(edges)
    for _ in range(MAX_ROUNDS):
        if state[0] == 0:
            break
        edges = kept(_small_star(_large_star(edges)))
        new = _state(edges)
        if new == state:
            break
        state = new
    else:
        raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()
