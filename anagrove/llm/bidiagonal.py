"""Singular values and right singular vectors of a small square matrix by qd recurrences.

Householder reflections reduce the matrix to an upper bidiagonal one. The dqds
recurrence finds all of its singular values to high relative accuracy; a twisted
factorisation at each of the wanted ones gives its vector without any iteration
over vectors. Work is cubic in the width for the reduction, quadratic for the rest.
"""

from __future__ import annotations

import math

import numpy as np

EPS = float(np.finfo(np.float64).eps)
TINY = 1e-290
# Values closer than this, relatively, share a cluster whose vectors are made orthogonal.
CLUSTER = 1e-6


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right factor W, with U^T r W upper bidiagonal."""
    a = np.array(r, dtype=np.float64)
    n = len(a)
    w = np.eye(n)
    for k in range(n):
        v = _reflector(a[k:, k])
        a[k:, k:] -= np.outer(v, v @ a[k:, k:])
        if k + 2 < n:
            v = _reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= np.outer(a[k:, k + 1 :] @ v, v)
            w[:, k + 1 :] -= np.outer(w[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), w


def _reflector(x: np.ndarray) -> np.ndarray:
    """v with (I - v v^T) x a multiple of the first unit vector."""
    size = np.abs(x).max()
    if size == 0:
        return np.zeros_like(x)
    v = x / size
    v[0] += math.copysign(np.linalg.norm(v), v[0])
    return v * (math.sqrt(2) / np.linalg.norm(v))


def _dqds_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float]:
    """One transform of the qd array of B^T B to that of B^T B - shift; and its smallest d."""
    d = q[0] - shift
    least, q_new, e_new = d, [], []
    for i in range(len(e)):
        total = d + e[i]
        q_new.append(total)
        ratio = q[i + 1] / total if total else math.inf
        e_new.append(e[i] * ratio)
        d = d * ratio - shift
        least = min(least, d) if d == d else math.nan
    q_new.append(d)
    return q_new, e_new, least if least == least else -math.inf


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, falling.

    Shifts stay below the smallest value left, so all q and e stay non-negative
    and every value keeps its relative accuracy; a shift that proves too large is
    taken back.
    """
    scale = max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0))
    if scale == 0:
        return np.zeros(len(diagonal))
    diagonal, above = diagonal / scale, above / scale
    found: list[float] = []
    # Zeros on the diagonal give zero values; a sweep without shift carries them to the end.
    parts = [(list(map(float, diagonal**2)), list(map(float, above**2)), 0.0)]
    while parts:
        q, e, sigma = parts.pop()
        limit = 60 * len(q) + 60
        shift = 0.0
        while q:
            n = len(q)
            if n == 1:
                found.append(q[0] + sigma)
                break
            if e[-1] <= EPS * EPS * (sigma + q[-1]) or e[-1] < TINY:
                found.append(q[-1] + sigma)
                q, e = q[:-1], e[:-1]
                continue
            cut = next((i for i in range(n - 2, -1, -1) if e[i] <= EPS * EPS * (sigma + min(q[i], q[i + 1])) or e[i] < TINY), None)
            if cut is not None:
                parts.append((q[: cut + 1], e[:cut], sigma))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if limit <= 0:
                raise ArithmeticError("singular values don't converge")
            limit -= 1
            q_new, e_new, least = _dqds_step(q, e, shift)
            while least < 0 and shift > 0:
                shift = 0.25 * shift if shift > EPS * q[-1] else 0.0
                q_new, e_new, least = _dqds_step(q, e, shift)
            q, e, sigma = [max(x, 0.0) for x in q_new], e_new, sigma + shift
            shift = max(0.0, least) * 0.98 if least < q[-1] else _bottom(q, e)
    return np.sort(np.array(found))[::-1] * scale**2


def _bottom(q: list[float], e: list[float]) -> float:
    """Just below the smaller value of the last two rows and columns."""
    a, b, c = q[-2], e[-1], q[-1]
    if len(e) > 1:
        a += e[-2]
    half = 0.5 * (a + b + c)
    low = half - math.sqrt(max(0.0, half * half - a * c))
    return max(0.0, min(low, c)) * (1 - 1e-10)


def _twisted(diagonal: np.ndarray, above: np.ndarray, value: float) -> np.ndarray:
    """Unit vector z of B^T B at ``value``, from the factorisation twisted where it is nearest to singular."""
    n = len(diagonal)
    floor = TINY + EPS * EPS * value
    d, l2d = diagonal**2, above**2
    product = diagonal[:-1] * above
    down, lower = np.empty(n), np.empty(n - 1)
    s = -value
    for i in range(n - 1):
        down[i] = s
        pivot = d[i] + s
        pivot = pivot if abs(pivot) > floor else -floor
        lower[i] = product[i] / pivot
        s = lower[i] * product[i] * s / d[i] - value if d[i] > floor else l2d[i] - product[i] * lower[i] - value
    down[n - 1] = s
    up, upper = np.empty(n), np.empty(n - 1)
    p = d[n - 1] - value
    for i in range(n - 2, -1, -1):
        up[i + 1] = p
        pivot = l2d[i] + p
        pivot = pivot if abs(pivot) > floor else -floor
        upper[i] = product[i] / pivot
        p = p * (d[i] / pivot) - value
    up[0] = p
    gamma = down + up + value
    k = int(np.abs(gamma).argmin())
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -lower[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -upper[i] * z[i]
    return z / np.linalg.norm(z)


def right_vectors(r: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """All squared singular values of ``r``, falling, and the unit right vectors of the first ``wanted``.

    Vectors are columns. Each vector is the twisted one at its value; within a
    cluster of close values they are made orthogonal to each other, and where that
    leaves too little, a unit vector fills in for it.
    """
    diagonal, above, w = bidiagonalise(r)
    scale = max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0))
    values = dqds(diagonal, above)
    if scale == 0:
        return values, np.eye(len(r))[:, :wanted]
    b, a = diagonal / scale, above / scale
    parts = _unreduced(b, a)
    owners = sorted(
        ((v, start, end) for start, end in parts for v in dqds(b[start:end], a[start : end - 1])), key=lambda x: -x[0]
    )
    vectors = np.zeros((len(b), wanted))
    for j, (value, start, end) in enumerate(owners[:wanted]):
        z = np.zeros(len(b))
        z[start:end] = _twisted(b[start:end], a[start : end - 1], value)
        near = [i for i in range(j) if owners[i][0] - value <= CLUSTER * owners[i][0]]
        vectors[:, j] = _orthogonal(z, vectors[:, near], b, a, value)
    return values, w @ vectors


def _unreduced(b: np.ndarray, a: np.ndarray) -> list[tuple[int, int]]:
    """Extents of the parts that vanishing superdiagonal entries leave."""
    cuts = [i + 1 for i in range(len(a)) if abs(a[i]) <= EPS * math.sqrt(TINY) + 1e-3 * EPS * min(abs(b[i]), abs(b[i + 1]))]
    ends = [*cuts, len(b)]
    return list(zip([0, *cuts], ends, strict=True))


def _orthogonal(z: np.ndarray, others: np.ndarray, b: np.ndarray, a: np.ndarray, value: float) -> np.ndarray:
    """``z`` less its part along ``others``; unit vectors stand in, refined by inverse steps, if none is left."""
    if not others.shape[1]:
        return z
    n = len(b)
    tridiagonal = np.diag(b**2 + np.concatenate([[0.0], a**2])) + np.diag(b[:-1] * a, 1) + np.diag(b[:-1] * a, -1)
    for start in [z, *np.eye(n)]:
        left = start
        for _ in range(2):
            left = left - others @ (others.T @ left)
        if np.linalg.norm(left) < 1 / (2 * n):
            continue
        for _ in range(3):
            try:
                solved = np.linalg.solve(tridiagonal - (value * (1 - 4 * EPS) - EPS) * np.eye(n), left)
            except np.linalg.LinAlgError:
                return left / np.linalg.norm(left)
            for _ in range(2):
                solved = solved - others @ (others.T @ solved)
            left = solved / np.linalg.norm(solved)
        return left
    return z
