"""Whitening of embeddings: exact integer sums, blockwise QR and a bidiagonal qd solver.

Components c become integers x = floor(64 c) + 1000000. The fit list has each
distinct x vector once; its size n and sums S are exact. Every task reduces its
centred rows x - S / n to a triangular factor, block by block, and the factors are
merged in a tree, so V = R^T R / n without a product of the data with itself. The
factor is bidiagonalised on the driver, dqds gives its singular values and twisted
factorisations the directions of the leading ones (``bidiagonal``). What the driver
gets has the square of the vectors' width, whatever the number of rows.

Defined cases: rows whose vector is null, empty, of another length than most, or
holds null or non-finite components or ones beyond ``LARGEST`` take no part, zero
vectors do; rows without an id keep a null id; repeated rows are given back each
and fitted once; directions without variance (all of them, for one distinct
vector) aren't components; a deviation beyond a long is null; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anagrove.llm.bidiagonal import EPS, right_vectors
from anagrove.session import materialise

SCALE, SHIFT = 64, 1_000_000
LARGEST = 2**33
COMPONENTS = 16
BLOCK_ROWS = 4_096
FAN_IN = 16
_LONG = 2**63 - 1


@dataclass
class Whitener:
    """Directions as columns, their variances, and the exact sums they were fitted on."""

    n: int
    sums: np.ndarray  # Python integers
    directions: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: machine integers where they are wide enough."""
        return _centred(x, self.n, self.sums)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x).astype(np.float64) / self.n @ self.directions / np.sqrt(self.variances)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of the squares of n x - S per row, None beyond a long."""
        y = self.centred(x)
        widest = int(np.abs(y).max(initial=0))
        if y.dtype == object or widest * widest * y.shape[1] > _LONG:
            y = y.astype(object)
        squares = (y * y).sum(axis=1).tolist()
        return [s if s <= _LONG else None for s in squares]


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    widest = n * int(np.abs(x).max(initial=0)) + max((abs(int(s)) for s in sums), default=0)
    if widest <= _LONG:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), -1)


def quantised(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(SHIFT).cast("long"))


def take_part(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``x`` of the rows that take part."""
    named = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    fits = F.forall("v", lambda c: F.coalesce(F.abs(c.cast("double")) <= LARGEST, F.lit(False)))
    valid = named.filter(F.col("v").isNotNull() & (F.size("v") > 0) & fits)
    widths = valid.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    usual = widths.orderBy(F.desc("n"), F.desc("d")).first()
    return valid.filter(F.size("v") == (usual.d if usual else 0)).select("id", quantised(F.col("v")).alias("x"))


def _sums(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """Rows of the fit list and their exact sums."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                total = _matrix(batch.column(0), np.int64).sum(axis=0)
                columns = [pa.array(np.arange(len(total))), pa.array(total), pa.array(np.full(len(total), batch.num_rows))]
                yield pa.RecordBatch.from_arrays(columns, names=["at", "s", "n"])

    per_batch = distinct.mapInArrow(add, "at long, s long, n long")
    total = per_batch.groupBy("at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
    rows = total.orderBy("at").collect()
    return (rows[0].n if rows else 0), np.array([int(r.s) for r in rows], dtype=object)


def _triangle(rows: np.ndarray) -> np.ndarray:
    """The square triangular factor of ``rows``."""
    r = np.linalg.qr(rows, mode="r")
    return np.vstack([r, np.zeros((r.shape[1] - len(r), r.shape[1]))])


def _factor(distinct: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """Triangular factor of all centred rows: per block, per task, then merged ``FAN_IN`` at a time."""
    width = len(sums)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                x = _matrix(batch.column(0).slice(at, BLOCK_ROWS), np.int64)
                block = _centred(x, n, sums).astype(np.float64) / n
                held = _triangle(block if held is None else np.vstack([held, block]))
        if held is not None:
            number = pa.array([TaskContext.get().partitionId()], pa.int64())
            yield pa.RecordBatch.from_arrays([number, pa.array([held.ravel()], pa.list_(pa.float64()))], names=["task", "r"])

    def merge(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        factors = [np.asarray(r).reshape(width, width) for r in part.sort_values("task")["r"]]
        return pd.DataFrame({"task": [key[0]], "r": [_triangle(np.vstack(factors)).ravel()]})

    factors = materialise(distinct.mapInArrow(reduce, "task long, r array<double>"))
    while factors.count() > 1:
        groups = factors.groupBy(F.floor(F.col("task") / FAN_IN).alias("key"))
        factors = materialise(groups.applyInPandas(merge, "task long, r array<double>"))
    return np.array(factors.first().r).reshape(width, width)


def _identity_error(distinct: DataFrame, model: Whitener) -> float:
    """Largest entry of the whitened fit list's covariance less the identity."""
    k = len(model.variances)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            w = model.whiten(_matrix(batch.column(0), np.int64)) if batch.num_rows else np.zeros((0, k))
            total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k)), pa.array(total.ravel())], names=["at", "p"])

    rows = distinct.mapInArrow(products, "at long, p double").groupBy("at").agg(F.sum("p").alias("p")).orderBy("at").collect()
    covariance = np.array([r.p for r in rows]).reshape(k, k) / model.n
    return float(np.abs(covariance - np.eye(k)).max())


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """Fit on the distinct ``x`` of ``vectors``; None without any."""
    distinct = materialise(vectors.select("x").distinct())
    n, sums = _sums(distinct)
    if not n:
        return None
    wanted = min(components, len(sums))
    squares, directions = right_vectors(_factor(distinct, n, sums), wanted)
    # Below this, a singular value is rounding of the largest one.
    kept = int((squares[:wanted] > squares[0] * (8 * len(sums) * EPS) ** 2).sum())
    variances = squares[:kept] / n
    model = Whitener(n, sums, directions[:, :kept], variances, squares[:kept] / max(squares.sum(), 1e-300))
    if kept:
        model.identity_error = _identity_error(distinct, model)
    return model


def transform(vectors: DataFrame, model: Whitener | None, id_col: str = "vec_id") -> DataFrame:
    """Id, ``component``, ``n``, ``deviation``, ``whitened``, ``explained`` and ``identity_error``."""
    measures = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    schema = T.StructType([vectors.schema["id"], *T.StructType.fromDDL(measures).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.variances) if model else 0
        for batch in batches:
            if not k:
                continue
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                rows = part.num_rows
                x = _matrix(part.column(1), np.int64)
                columns = [
                    part.column(0).take(pa.array(np.repeat(np.arange(rows), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, model.n)),
                    pa.array(model.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(rows), k))),
                    pa.array(model.whiten(x).ravel()),
                    pa.array(np.tile(model.explained, rows)),
                    pa.array(np.full(rows * k, model.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return vectors.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def whiten(rows: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Fit on all rows that take part and give each its leading whitened components."""
    vectors = take_part(rows, id_col, vector_col)
    return transform(vectors, fit(vectors, components), id_col)
