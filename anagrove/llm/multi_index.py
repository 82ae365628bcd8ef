"""Inverted multi-index: a product grid of codebooks over two vector halves.

Each half of a vector is quantised with its own codebook. The grid of all pairs of
centroids has ``k * k`` cells; a vector lies in the cell of its two nearest
centroids. From a query, cells are visited in the order of the summed squared
distances to their centroids, by a heap over the two sorted distance lists.

The codebooks are fitted on a bounded sample (``SAMPLE_ROWS``, chosen by a hash of
the content); every valid row is indexed. ``k`` grows with the square root of the
rows up to ``MAX_CENTROIDS``, so that cells stay small; beyond that they grow.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 8192
MAX_CENTROIDS = 1024
CELL_ROWS = 8
ROUNDS = 10


def is_valid(vector: Column) -> Column:
    """Whether a vector is present, of finite numbers, and not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def vectors(column: pa.Array) -> np.ndarray:
    """Double-precision rows of a list column without nulls."""
    flat = column.flatten() if hasattr(column, "flatten") else column
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _squared(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    cross = points @ centroids.T
    return (points**2).sum(axis=1)[:, None] - 2 * cross + (centroids**2).sum(axis=1)[None, :]


def fit_codebook(points: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Lloyd's algorithm from ``k`` of the sample's points."""
    points = np.unique(points, axis=0)
    k = min(k, len(points))
    centroids = points[np.random.default_rng(seed).choice(len(points), k, replace=False)]
    for _ in range(ROUNDS):
        nearest = _squared(points, centroids).argmin(axis=1)
        count = np.bincount(nearest, minlength=k)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        filled = count > 0
        centroids[filled] = sums[filled] / count[filled, None]
    return centroids


class Grid:
    """Two codebooks and how to find one's way in their product."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.first, self.second = first, second
        self.half = first.shape[1]

    @classmethod
    def fit(cls, sample: np.ndarray, k: int) -> Grid:
        half = sample.shape[1] // 2
        return cls(fit_codebook(sample[:, :half], k, 1), fit_codebook(sample[:, half:], k, 2))

    def distances(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _squared(points[:, : self.half], self.first), _squared(points[:, self.half :], self.second)

    def cells(self, points: np.ndarray) -> np.ndarray:
        one, two = self.distances(points)
        return one.argmin(axis=1) * len(self.second) + two.argmin(axis=1)


def visit(one: np.ndarray, two: np.ndarray) -> Iterator[tuple[float, int]]:
    """Cells by rising ``one[i] + two[j]``: the multi-sequence traversal.

    A cell enters the heap once its neighbours before it in both sorted lists
    have left it, so the heap holds a frontier of at most one cell per row.
    """
    rows, columns = np.argsort(one, kind="stable").tolist(), np.argsort(two, kind="stable").tolist()
    a, b = one[rows].tolist(), two[columns].tolist()
    reached = [0] * len(a)  # of each sorted row: how many of its cells have left
    heap = [(a[0] + b[0], 0, 0)]
    wide = len(b)
    while heap:
        total, i, j = heapq.heappop(heap)
        yield total, rows[i] * wide + columns[j]
        reached[i] = j + 1
        if j + 1 < wide and (i == 0 or reached[i - 1] > j + 1):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if i + 1 < len(a) and reached[i + 1] == j:
            heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))


def sample_of(valid: DataFrame, column: str, rows: int = SAMPLE_ROWS) -> np.ndarray:
    """A bounded sample of distinct vectors, the same at every run."""
    chosen = valid.select(F.col(column).alias("v")).orderBy(F.xxhash64("v")).limit(rows)
    table = chosen.toArrow()
    return vectors(table.column("v").combine_chunks()) if table.num_rows else np.zeros((0, 0))


def centroids_for(rows: int) -> int:
    return int(min(MAX_CENTROIDS, max(4, np.ceil(np.sqrt(rows / CELL_ROWS)))))
