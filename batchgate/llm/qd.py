"""Singular values and right singular vectors of a small matrix by qd transforms (part of operator 13).

Householder reflections make the matrix bidiagonal; dqds finds its singular values, each to high relative
accuracy; a twisted factorisation at each value, the place of its smallest pivot taken as the twist, gives
the vector.  Vectors of values that lie close together come from inverse iteration, each made orthogonal
to those before.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
#: Neighbours closer than this, relative to the larger one, share an orthogonal basis found together.
CLOSE = 1e-3


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """A unit vector whose reflection turns ``x`` to a multiple of the first axis, and that multiple."""
    size = np.linalg.norm(x)
    v = x.copy()
    if size == 0:
        return v, 0.0
    head = -np.copysign(size, x[0])
    v[0] -= head
    return v / np.linalg.norm(v), head


def bidiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``diagonal, upper, V`` with ``a = U B V^T`` for a square ``a``; U is not kept."""
    a, d = a.copy(), len(a)
    right = np.eye(d)
    main, upper = np.zeros(d), np.zeros(max(d - 1, 0))
    for k in range(d):
        v, main[k] = _reflector(a[k:, k])
        a[k:, k + 1 :] -= 2 * np.outer(v, v @ a[k:, k + 1 :])
        if k + 1 < d:
            v, upper[k] = _reflector(a[k, k + 1 :])
            a[k + 1 :, k + 1 :] -= 2 * np.outer(a[k + 1 :, k + 1 :] @ v, v)
            right[:, k + 1 :] -= 2 * np.outer(right[:, k + 1 :] @ v, v)
    return main, upper, right


def _dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One transform of the qd array, and its pivots less the shift; the pivots tell whether it may be used."""
    d = q[0] - shift
    new_q, new_e, pivots = [], [], [d]
    for k in range(len(e)):
        total = d + e[k]
        if total <= 0:
            return [], [], [-1.0]
        ratio = q[k + 1] / total
        new_q.append(total)
        new_e.append(e[k] * ratio)
        d = d * ratio - shift
        pivots.append(d)
    new_q.append(d)
    return new_q, new_e, pivots


def _block_values(q: list[float], e: list[float]) -> list[float]:
    """Squared singular values of a bidiagonal block, given the squares of its entries."""
    values, shifted = [], 0.0
    while q:
        if len(q) == 1:
            values.append(shifted + q[0])
            break
        if e[-1] <= EPS * EPS * (shifted + q[-1]):
            values.append(shifted + q.pop())
            e.pop()
            continue
        cut = next((k for k in range(len(e) - 1, -1, -1) if e[k] <= EPS * EPS * shifted), None)
        if cut is not None:
            values += [shifted + v for v in _block_values(q[cut + 1 :], e[cut + 1 :])]
            q, e = q[: cut + 1], e[:cut]
            continue
        q, e, pivots = _dqds(q, e, 0.0)
        least = min(pivots)
        if least <= 0:
            values.append(shifted)
            q, e = q[:-1], e[:-1]
            continue
        # The sum of inverse pivots is the trace of the inverse, so this is below the smallest value.
        safe = (1 - 4 * EPS * len(q)) / sum(1 / p for p in pivots)
        for shift in (least * (1 - 8 * EPS) - e[-1], safe):
            if shift > 0:
                tried = _dqds(q, e, shift)
                if min(tried[2]) >= 0:
                    q, e = tried[:2]
                    shifted += shift
                    break
    return values


def _splits(main: np.ndarray, upper: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of the bidiagonal that no entry above rounding connects."""
    size = np.sqrt(np.max(main**2) + (np.max(upper**2) if len(upper) else 0.0))
    cuts = np.flatnonzero(np.abs(upper) <= EPS * 1e-3 * size) + 1
    return list(zip([0, *cuts], [*cuts, len(main)], strict=True))


def _twisted(q: np.ndarray, e: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of the block's B^T B at the values ``at``; q and e are entries of B."""
    n, m = len(q), len(at)
    d, low = q * q, e / q[:-1]
    tiny = np.finfo(np.float64).tiny * 1e16
    s, p = np.empty((n, m)), np.empty((n, m))
    forward, backward = np.empty((max(n - 1, 0), m)), np.empty((max(n - 1, 0), m))
    s[0], p[n - 1] = -at, d[n - 1] - at
    for k in range(n - 1):
        pivot = s[k] + d[k]
        pivot[pivot == 0] = tiny
        forward[k] = d[k] * low[k] / pivot
        s[k + 1] = forward[k] * low[k] * s[k] - at
    for k in range(n - 2, -1, -1):
        pivot = d[k] * low[k] * low[k] + p[k + 1]
        pivot[pivot == 0] = tiny
        ratio = d[k] / pivot
        backward[k] = low[k] * ratio
        p[k] = p[k + 1] * ratio - at
    twist = np.abs(s + p + at).argmin(axis=0)
    z = np.zeros((n, m))
    z[twist, np.arange(m)] = 1.0
    for k in range(n - 2, -1, -1):
        z[k] = np.where(k < twist, -forward[k] * z[k + 1], z[k])
    for k in range(n - 1):
        z[k + 1] = np.where(k >= twist, -backward[k] * z[k], z[k + 1])
    return z / np.linalg.norm(z, axis=0)


def _inverse(q: np.ndarray, e: np.ndarray, at: float, earlier: np.ndarray, seed: int) -> np.ndarray:
    """A unit eigenvector near ``at`` orthogonal to the columns of ``earlier``, by inverse iteration."""
    tri = np.diag(q * q)
    tri[np.arange(1, len(q)), np.arange(1, len(q))] += e * e
    tri[np.arange(len(q) - 1), np.arange(1, len(q))] = tri[np.arange(1, len(q)), np.arange(len(q) - 1)] = q[:-1] * e
    x = np.random.default_rng(seed).standard_normal(len(q))
    away = at * (1 + 4 * EPS) + EPS * EPS
    for _ in range(4):
        x = np.linalg.solve(tri - away * np.eye(len(q)), x)
        for _ in range(2):
            x -= earlier @ (earlier.T @ x)
        x /= np.linalg.norm(x)
    return x


def singular(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Singular values of a square matrix, falling, and its right singular vectors as columns.

    Values that are nothing but rounding are 0; vectors of those still complete the basis.
    """
    d = len(a)
    if d == 0 or not np.any(a):
        return np.zeros(d), np.eye(d)
    scale = np.abs(a).max()
    main, upper, right = bidiagonal(a / scale)
    values, vectors = np.zeros(d), np.zeros((d, d))
    least = EPS * np.sqrt(np.max(main**2) + (np.max(upper**2) if d > 1 else 0.0)) * 1e-3
    for lo, hi in _splits(main, upper):
        # A qd array has no zero entries; this moves the matrix by less than rounding has.
        q, e = np.where(np.abs(main[lo:hi]) < least, least, main[lo:hi]), upper[lo : hi - 1]
        found = np.sort(_block_values((q * q).tolist(), (e * e).tolist()))[::-1]
        z = _twisted(q, e, found)
        for k in range(1, hi - lo):
            first = k
            while first and found[first - 1] - found[first] <= CLOSE * found[first - 1]:
                first -= 1
            if first < k:
                z[:, k] -= z[:, first:k] @ (z[:, first:k].T @ z[:, k])
                size = np.linalg.norm(z[:, k])
                if size > 0.5:
                    z[:, k] /= size
                    z[:, k] -= z[:, first:k] @ (z[:, first:k].T @ z[:, k])
                    z[:, k] /= np.linalg.norm(z[:, k])
                else:
                    z[:, k] = _inverse(q, e, found[k], z[:, first:k], k)
        values[lo:hi], vectors[lo:hi, lo:hi] = np.sqrt(found), z
    order = np.argsort(-values, kind="stable")
    values = values[order] * scale
    values[values <= d * EPS * values[0]] = 0.0
    return values, right @ vectors[:, order]
