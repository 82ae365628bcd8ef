"""Truncated SVD by a randomised range finder and a tree of QR factorisations.

For ``k`` far below the width d of the vectors. A d x l block of directions (l a
little above k) is multiplied by the data and back a few times, each time summed over
all rows and made orthogonal; then every task reduces its rows of (data x block) to an
l x l triangle, and triangles are merged in a tree. The driver gets d x l sums and one
triangle, never a d x d matrix, and nothing that grows with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anagrove.session import materialise

OVERSAMPLING = 10
POWER_STEPS = 6
FAN_IN = 16
SEED = 0


def _rows(column: pa.Array, width: int) -> np.ndarray:
    """Vectors of a batch, null ones left out."""
    return column.drop_null().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _times_gram(vectors: DataFrame, block: np.ndarray) -> np.ndarray:
    """A^T (A block), summed over all rows of A."""
    width, size = block.shape

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(block.shape)
        for batch in batches:
            rows = _rows(batch.column(0), width)
            total += rows.T @ (rows @ block)
        at = pa.array(np.arange(width, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([at, pa.array(list(total), pa.list_(pa.float64()))], names=["at", "v"])

    parts = vectors.mapInArrow(multiply, "at int, v array<double>")
    sums = parts.groupBy("at").agg(*[F.sum(F.col("v")[j]).alias(f"v{j}") for j in range(size)])
    return np.array([r[1:] for r in sums.orderBy("at").collect()]).reshape(width, size)


def _triangle(rows: np.ndarray) -> np.ndarray:
    r = np.linalg.qr(rows, mode="r")
    return np.vstack([r, np.zeros((r.shape[1] - len(r), r.shape[1]))])


def _tree_qr(vectors: DataFrame, block: np.ndarray) -> np.ndarray:
    """Triangular factor of A block: one per task, then merged ``FAN_IN`` at a time."""
    width, size = block.shape

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((size, size))
        for batch in batches:
            held = _triangle(np.vstack([held, _rows(batch.column(0), width) @ block]))
        number = pa.array([TaskContext.get().partitionId()], pa.int64())
        yield pa.RecordBatch.from_arrays([number, pa.array([held.ravel()], pa.list_(pa.float64()))], names=["task", "r"])

    def merge(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        triangles = [np.asarray(r).reshape(size, size) for r in part.sort_values("task")["r"]]
        return pd.DataFrame({"task": [key[0]], "r": [_triangle(np.vstack(triangles)).ravel()]})

    factors = materialise(vectors.mapInArrow(reduce, "task long, r array<double>"))
    while factors.count() > 1:
        groups = factors.groupBy(F.floor(F.col("task") / FAN_IN).alias("key"))
        factors = materialise(groups.applyInPandas(merge, "task long, r array<double>"))
    return np.array(factors.first().r).reshape(size, size)


def randomised_svd(df: DataFrame, k: int, column: str = "embedding", power_steps: int = POWER_STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors (d x k) and singular values, the largest first, of the uncentred vectors.

    Null vectors are left out; vectors must be of one length. Signs are fixed by each
    vector's largest component, which is positive. Each power step multiplies the error
    by the squared ratio of the first singular value that is left out to the kept one.
    """
    vectors = materialise(df.select(F.col(column).cast("array<double>").alias("v")).filter(F.col("v").isNotNull()))
    first = vectors.select(F.size("v")).first()
    if first is None:
        return np.zeros((0, 0)), np.zeros(0)
    width = first[0]
    size = min(width, k + OVERSAMPLING)
    block = np.linalg.qr(np.random.default_rng(SEED).normal(size=(width, size)))[0]
    for _ in range(power_steps):
        block = np.linalg.qr(_times_gram(vectors, block))[0]
    _, values, turned = np.linalg.svd(_tree_qr(vectors, block))
    factors = (block @ turned.T)[:, :k]
    largest = factors[np.abs(factors).argmax(axis=0), np.arange(factors.shape[1])]
    return factors * np.where(largest < 0, -1.0, 1.0), values[:k]


def lost_squares(vector: Column, factors: np.ndarray) -> Column:
    """Squared length of what a vector has outside the span of the factors."""

    @F.pandas_udf("double")
    def outside(vectors: pd.Series) -> pd.Series:
        rows = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
        rest = rows - (rows @ factors) @ factors.T
        return pd.Series((rest**2).sum(axis=1))

    return outside(vector)
