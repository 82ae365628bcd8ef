"""Whitening against dense eigenvectors and exact integers."""

import math

import numpy as np
import pytest

from anagrove.llm import bidiagonal, whitening

ROWS = "vec_id long, embedding array<float>, label int, x string, n long"


def brute(rows):
    """Per kept row the exact deviation; n, and eigenpairs of the fit list's covariance."""
    kept = [(r[0], [math.floor(64 * float(c)) + 1_000_000 for c in r[1]]) for r in rows if usable(r[1])]
    distinct = sorted({tuple(x) for _, x in kept})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct, strict=True)]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums, strict=True)] for x in distinct])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    deviations = [sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True)) for _, x in kept]
    own = np.array([[(n * c - s) / n for c, s in zip(x, sums, strict=True)] for _, x in kept])
    return kept, n, deviations, own, values[::-1], vectors[:, ::-1]


def usable(vector):
    return vector is not None and all(c is not None and math.isfinite(c) for c in vector)


def planted(seed, rows, width):
    rng = np.random.default_rng(seed)
    data = rng.normal(size=(rows, width)) * np.linspace(3, 0.2, width)
    data[rows // 2 :] = data[0]
    given = [(i, [float(np.float32(c)) for c in v], 1, "x", 0) for i, v in enumerate(data)]
    return given + [
        (None, given[1][1], None, None, None),
        (-1, None, 1, "x", 0),
        (-2, [float("nan")] * width, 1, "x", 0),
        (-3, [None] + [0.0] * (width - 1), 1, "x", 0),
        (-4, [float("inf")] * width, 1, "x", 0),
        (-5, [0.0] * width, 1, "x", 0),
    ]


@pytest.mark.parametrize("rows,width,seed", [(400, 24, 0), (90, 40, 1), (60, 5, 2)])
def test_equal_to_dense_eigenvectors(spark, rows, width, seed):
    given = planted(seed, rows, width)
    found = whitening.whiten(spark.createDataFrame(given, ROWS).repartition(40)).collect()
    kept, n, deviations, own, values, vectors = brute(given)
    k = min(16, width)
    by_id: dict = {}
    for r in found:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    assert set(by_id) == {i for i, _ in kept} and all(sorted(c) == list(range(1, k + 1)) for c in by_id.values())
    expected = own @ vectors[:, :k] / np.sqrt(values[:k])
    ours = np.array([[by_id[i][c].whitened for c in range(1, k + 1)] for i, _ in kept])
    sign = np.sign((expected * ours).sum(axis=0))
    assert np.abs(expected * sign - ours).max() < 1e-8
    for (i, _), deviation in zip(kept, deviations, strict=True):
        assert {(r.n, r.deviation) for r in by_id[i].values()} == {(n, deviation)}
    share = values[:k] / values.sum()
    assert all(abs(r.explained / share[r.component - 1] - 1) < 1e-10 and r.identity_error < 1e-9 for r in found)


def test_rank_bounds_the_components(spark):
    line = [(i, [float(i), 2.0 * i, 0.0], 1, "x", 0) for i in range(10)]
    assert {r.component for r in whitening.whiten(spark.createDataFrame(line, ROWS)).collect()} == {1}
    assert whitening.whiten(spark.createDataFrame(line[:1] * 5, ROWS)).collect() == []
    assert whitening.whiten(spark.createDataFrame([], ROWS)).collect() == []


def test_exact_beyond_machine_integers():
    sums = np.array([3 * 2**61, 5], dtype=object)
    model = whitening.Whitener(2**30, sums, np.eye(2), np.ones(2), np.ones(2))
    assert model.deviations(np.array([[6 * 2**30, 0], [2**39, 1]])) == [25, None]


MATRICES = {
    "random": np.random.default_rng(0).normal(size=(40, 40)),
    "identity": np.eye(12),
    "repeated": np.diag([3.0, 3, 3, 2, 2, 1, 0, 0]),
    "zero": np.zeros((5, 5)),
    "graded": np.diag(10.0 ** -np.arange(30)),
    "low rank": np.random.default_rng(1).normal(size=(30, 6)) @ np.random.default_rng(2).normal(size=(6, 30)),
    "clusters": np.diag([5.0] * 15 + [1.0] * 17) @ np.linalg.qr(np.random.default_rng(3).normal(size=(32, 32)))[0],
    "near clusters": np.diag(1 + 1e-9 * np.arange(20)) @ np.linalg.qr(np.random.default_rng(4).normal(size=(20, 20)))[0],
    "one": np.array([[2.0]]),
    "ones": np.triu(np.ones((25, 25))),
}


@pytest.mark.parametrize("name", MATRICES)
def test_solver_on(name):
    r = np.linalg.qr(MATRICES[name])[1]
    k = min(16, len(r))
    squares, vectors = bidiagonal.right_vectors(r, k)
    top = max(np.linalg.svd(r, compute_uv=False)[0], 1e-100)
    assert np.abs(np.sqrt(squares) - np.linalg.svd(r, compute_uv=False)).max() < 1e-13 * top
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-11
    assert np.abs(r.T @ (r @ vectors) - vectors * squares[:k]).max() < 1e-13 * top**2


def test_small_values_keep_their_digits():
    b, a = 10.0 ** -np.arange(12), 0.5 * 10.0 ** -np.arange(1, 12)
    exact = bidiagonal.dqds(b, a)
    assert abs(np.sum(np.log(exact)) - 2 * np.sum(np.log(b))) < 1e-11
