"""Connected components of a distributed graph, by alternating star steps.

Every round points the neighbours of each vertex at the smallest vertex among
them, first those larger than it, then the others. The number of rounds grows
with the logarithm of the longest path. A vertex with many edges is only ever
joined and summed, never gathered; rounds are written to the shared folder.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anagrove.session import materialise


def _towards_smallest(arcs: DataFrame) -> DataFrame:
    """Each arc with the smallest vertex among its start and the start's ends."""
    least = arcs.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return arcs.join(least, "a")


def _round(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    large = _towards_smallest(both).filter("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    small = _towards_smallest(large.distinct())
    others = small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(small.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``vertex`` and ``root``, the smallest vertex it is linked to, for every vertex with an edge.

    ``edges`` has two columns of one orderable type. Loops, nulls, repeated and
    reversed edges are allowed; nulls and loops are ignored.
    """
    a, b = edges.columns
    current = materialise(
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .distinct()
    )

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first())

    state = mark(current)
    while state[0]:
        current = materialise(_round(current))
        now = mark(current)
        if now == state:
            break
        state = now
    roots = current.select(F.col("b").alias("vertex"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("vertex"), F.col("b").alias("root")).union(roots)


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest vertex reachable from each of ``n`` vertices, over edges left[i] - right[i]."""
    root = np.arange(n)
    while len(left):
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, root[left], low)
        np.minimum.at(root, root[right], low)
        root = root[root]
        if np.array_equal(root, before):
            break
    while not np.array_equal(root, root[root]):
        root = root[root]
    return root
