"""Leading eigenpairs of a symmetric matrix by contour integration (FEAST).

An interval of the spectrum is cut out by a circle around it. The integral of the resolvent
``(z I - V)^-1 Y`` along the circle, taken by Gauss-Legendre quadrature, projects random
columns ``Y`` onto the eigenvectors inside; Rayleigh-Ritz on that subspace gives eigenpairs,
and the step is repeated with the Ritz vectors until residuals vanish. The inertia of
``V - s I`` counts the eigenvalues above ``s``: counts place the intervals, and each interval
must return as many pairs as its counts say.

The matrix has the size of a vector's dimension squared, whatever the number of rows.
"""

from __future__ import annotations

import numpy as np

NODES = 8
#: An interval with more eigenvalues is halved.
WIDEST = 6
ROUNDS = 24


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a similar tridiagonal matrix (Householder)."""
    a = matrix.copy()
    for k in range(len(a) - 2):
        x = a[k + 1 :, k].copy()
        norm = np.linalg.norm(x)
        if norm == 0:
            continue
        x[0] += norm if x[0] >= 0 else -norm
        v = x / np.linalg.norm(x)
        a[k + 1 :, :] -= 2 * np.outer(v, v @ a[k + 1 :, :])
        a[:, k + 1 :] -= 2 * np.outer(a[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def count_above(diagonal: np.ndarray, off: np.ndarray, shift: float) -> int:
    """Eigenvalues above ``shift``: positive pivots of the shifted matrix."""
    tiny = np.finfo(float).tiny ** 0.5
    above, pivot = 0, np.inf
    for k, d in enumerate(diagonal):
        pivot = d - shift - (off[k - 1] ** 2 / pivot if k else 0.0)
        if pivot == 0:
            pivot = -tiny
        above += pivot > 0
    return above


def _projected(v: np.ndarray, low: float, high: float, y: np.ndarray) -> np.ndarray:
    centre, radius = (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    total = np.zeros_like(y)
    for x, w in zip(nodes, weights, strict=True):
        turn = np.exp(1j * np.pi / 2 * (1 - x))
        solved = np.linalg.solve((centre + radius * turn) * np.eye(len(v)) - v, y)
        total += w / 2 * (radius * turn * solved).real
    return total


def interval_pairs(
    v: np.ndarray, low: float, high: float, count: int
) -> tuple[np.ndarray, np.ndarray] | None:
    """The ``count`` eigenpairs with values in (low, high]; None if they do not settle."""
    norm = np.abs(v).sum(axis=0).max()
    width = min(len(v), max(count + 4, 2 * count))
    q = np.random.default_rng(count).standard_normal((len(v), width))
    best = None
    for _ in range(ROUNDS):
        q = np.linalg.qr(_projected(v, low, high, q))[0]
        values, turned = np.linalg.eigh(q.T @ v @ q)
        q = q @ turned
        inside = (values > low) & (values <= high)
        if inside.sum() != count:
            best = None
            continue
        residual = np.abs(v @ q[:, inside] - q[:, inside] * values[inside]).max()
        if best is not None and residual >= best[0] / 2:
            break
        best = (residual, values[inside], q[:, inside])
    if best is None or best[0] > 1e-11 * norm:
        return None
    return best[1], best[2]


def leading(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues of ``v``, falling, and their unit vectors as columns.

    Values that are zero up to rounding are left out.
    """
    dims = len(v)
    v = (v + v.T) / 2
    norm = np.abs(v).sum(axis=0).max() if dims else 0.0
    if norm == 0 or not np.isfinite(norm):
        return np.empty(0), np.empty((dims, 0))
    v, scale = v / norm, norm
    diagonal, off = tridiagonal(v)
    # halves are not exact, so that a shift seldom meets an eigenvalue of a simple matrix
    split = 0.4871
    floor, top = 16 * dims * np.finfo(float).eps, 1.0 + 1e-9
    above = {floor: count_above(diagonal, off, floor), top: 0}
    wanted = min(most, above[floor])
    todo, found = [(floor, top)], []
    while todo:
        low, high = todo.pop()
        count = above[low] - above[high]
        if above[high] >= wanted or not count:
            continue
        pairs = None
        if count <= WIDEST or high - low < 1e-9:
            pairs = interval_pairs(v, low, high, count)
        if pairs is None:
            if high - low < 1e-12:
                raise ArithmeticError(f"{count} eigenvalues of an interval were not found")
            middle = low + split * (high - low)
            above[middle] = count_above(diagonal, off, middle)
            todo += [(low, middle), (middle, high)]
            continue
        found.append(pairs)
    values = np.concatenate([x for x, _ in found])
    vectors = np.concatenate([y for _, y in found], axis=1)
    order = np.argsort(-values, kind="stable")[:wanted]
    if len(order) != wanted:
        raise ArithmeticError(f"{len(order)} of {wanted} eigenpairs were found")
    return values[order] * scale, vectors[:, order]
