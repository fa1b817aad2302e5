"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import staged


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over ``a, b``: neighbours move to the least vertex of a neighbourhood.

    The minimum is a plain aggregate with partial sums per task; a vertex with very many edges
    then meets its single minimum in a join whose edge side adaptive execution can split.
    """
    if large:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    moved = both.join(least, "a")
    if large:
        out = moved.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        out = moved.select(F.col("b").alias("a"), F.col("least").alias("b")).union(least.select("a", F.col("least").alias("b")))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``vertex, component`` (its least vertex) for every vertex of ``edges(a, b)`` of type long.

    Each round is written to the shared folder; the rounds end when the edges no longer change,
    after a number that grows with the logarithm of the table.  Vertices without an edge to
    another one have no row.
    """
    current = staged(edges.filter("a <> b").distinct(), "edges")
    before = None
    for _ in range(rounds):
        current = staged(_stars(_stars(current, True), False), "stars")
        now = current.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return current.select(F.col("a").alias("vertex"), F.col("b").alias("component")).union(
        current.select(F.col("b").alias("vertex"), F.col("b").alias("component"))).distinct()
