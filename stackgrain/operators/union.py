"""Connected components of an edge table by alternating stars: a union-find that no task holds whole.

In each round every node passes its smallest neighbour on to its larger ones, then its larger neighbours are moved under
the smallest; the edges become stars around the smallest node of each component, in a number of rounds that grows with
the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .slices import once


def stars(edges: DataFrame, keys: list[str], most: int = 60) -> DataFrame:
    """(keys, node, root) of undirected edges (keys, a, b): the smallest node that each node other than it reaches. Edges
    join nodes of equal keys only."""

    def kept(pairs: DataFrame) -> DataFrame:
        return once(pairs.where("a <> b").distinct())

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64(*keys, "a", "b").cast("decimal(38, 0)"))).first())

    now = kept(edges.select(*keys, F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    before = state(now)
    for _ in range(most):
        both = now.unionByName(now.select(*keys, F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(*keys, "a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = kept(both.where("b > a").join(low, [*keys, "a"]).select(*keys, F.col("b").alias("a"), F.col("m").alias("b")))
        low = large.groupBy(*keys, "a").agg(F.min("b").alias("m"))
        small = large.join(low, [*keys, "a"]).select(*keys, F.col("b").alias("a"), F.col("m").alias("b"))
        now = kept(small.unionByName(low.select(*keys, "a", F.col("m").alias("b"))))
        after = state(now)
        if after == before:
            return now.select(*keys, F.col("a").alias("node"), F.col("b").alias("root"))
        before = after
    raise RuntimeError("components did not settle")
