"""Singular values and right singular vectors of a small square matrix by qd algorithms.

Householder reflections make the matrix bidiagonal; the dqds iteration finds its squared singular values to
high relative accuracy; twisted factorisations of the shifted product give one vector per value.
(Fernando and Parlett 1994; Dhillon and Parlett 2004.)
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
#: Values closer than this, relative to the larger one, form a cluster whose vectors are made orthogonal.
CLUSTER = 1e-3


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right factor ``v`` with ``matrix = u @ bidiagonal @ v.T``."""
    a = np.array(matrix, float)
    n = a.shape[1]
    v = np.eye(n)

    def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
        """A unit vector ``w`` so that ``x - 2 w (w.x)`` has its first component only, and that component."""
        norm = float(np.linalg.norm(x))
        if norm == 0.0:
            return np.zeros_like(x), 0.0
        head = -norm if x[0] >= 0 else norm
        w = x.copy()
        w[0] -= head
        length = float(np.linalg.norm(w))
        return (w / length, head) if length else (w, head)

    diagonal, upper = np.zeros(n), np.zeros(max(n - 1, 0))
    for k in range(n):
        w, diagonal[k] = reflector(a[k:, k])
        a[k:, k:] -= 2.0 * np.outer(w, w @ a[k:, k:])
        if k + 1 < n:
            w, upper[k] = reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= 2.0 * np.outer(a[k:, k + 1 :] @ w, w)
            v[:, k + 1 :] -= 2.0 * np.outer(v[:, k + 1 :] @ w, w)
    return diagonal, upper, v


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One differential qd step: the new ``q`` and ``e``, and the intermediate ``d``."""
    d = q[0] - shift
    new_q, new_e, between = [], [], [d]
    for i, off in enumerate(e):
        total = d + off
        if total <= 0.0:
            return [], [], [-1.0]
        ratio = q[i + 1] / total
        new_q.append(total)
        new_e.append(off * ratio)
        d = d * ratio - shift
        between.append(d)
    new_q.append(d)
    return new_q, new_e, between


def squared_singular_values(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """The squares of a bidiagonal matrix's singular values, falling.

    A step without shift gives ``d`` whose inverses add up to the trace of the inverse, so one over that
    sum is below the least value and a safe shift for the next step.
    """
    tiny = max(float(np.max(np.abs(diagonal), initial=0.0)) ** 2, float(np.max(np.abs(upper), initial=0.0)) ** 2) * 1e-60
    found: list[float] = []
    blocks = [([max(float(x) ** 2, tiny) for x in diagonal], [float(x) ** 2 for x in upper], 0.0)]
    negligible = (10 * EPS) ** 2
    while blocks:
        q, e, moved = blocks.pop()
        for _ in range(60 * len(q) + 60):
            if len(q) <= 1:
                break
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= negligible * (moved + min(q[i], q[i + 1]))), None)
            if cut is not None:
                blocks.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if 1.5 * q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            q, e, between = _sweep(q, e, 0.0)
            if min(between) <= 0.0:
                q[-1] = max(q[-1], tiny)
                continue
            shift = (1.0 - 8 * EPS * len(q)) / sum(1.0 / d for d in between)
            shifted = _sweep(q, e, shift)
            if min(shifted[2]) >= 0.0:
                q, e, moved = shifted[0], shifted[1], moved + shift
                q[-1] = max(q[-1], tiny)
        if len(q) > 1:
            raise ArithmeticError("dqds did not converge")
        found += [x + moved for x in q]
    return np.array(sorted(found, reverse=True))


def _twisted(d: np.ndarray, l: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Both factorisations of ``L D L' - value``: the multipliers from above and from below, and the twists."""
    n = len(d)
    least = EPS * EPS * (abs(value) + float(np.max(d)))
    above, below = np.zeros(max(n - 1, 0)), np.zeros(max(n - 1, 0))
    s, p = np.zeros(n), np.zeros(n)
    s[0] = -value
    for i in range(n - 1):
        pivot = d[i] + s[i]
        if abs(pivot) < least:
            pivot = -least
        above[i] = d[i] * l[i] / pivot
        s[i + 1] = above[i] * l[i] * s[i] - value
    p[-1] = d[-1] - value
    for i in range(n - 2, -1, -1):
        pivot = d[i] * l[i] * l[i] + p[i + 1]
        if abs(pivot) < least:
            pivot = -least
        ratio = d[i] / pivot
        below[i] = l[i] * ratio
        p[i] = p[i + 1] * ratio - value
    return above, below, s + p + value


def _vectors(diagonal: np.ndarray, upper: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit vectors of the product of an unreduced bidiagonal matrix, a column per value, falling."""
    n = len(diagonal)
    scale = max(float(np.max(np.abs(diagonal))), float(np.max(np.abs(upper), initial=0.0)), np.finfo(float).tiny)
    a = np.where(np.abs(diagonal) < EPS * 1e-2 * scale, EPS * 1e-2 * scale, diagonal)
    d, l = a * a, upper / a[:-1]
    out = np.zeros((n, n))
    zero = (10 * n * EPS) ** 2 * values[0]  # below it, values are rounding errors and form one cluster
    first = 0  # where the cluster of the present value starts
    for k, value in enumerate(values):
        if k and values[k - 1] > zero and values[k - 1] - value > CLUSTER * values[k - 1]:
            first = k
        above, below, twists = _twisted(d, l, value)
        best = np.zeros(n)
        for r in np.argsort(np.abs(twists)):
            z = np.zeros(n)
            z[r] = 1.0
            for i in range(r - 1, -1, -1):
                z[i] = -above[i] * z[i + 1]
            for i in range(r, n - 1):
                z[i + 1] = -below[i] * z[i]
            z /= np.linalg.norm(z)
            for _ in range(2):
                z -= out[:, first:k] @ (out[:, first:k].T @ z)
            if not np.all(np.isfinite(z)):
                continue
            if np.linalg.norm(z) > np.linalg.norm(best):
                best = z
            if np.linalg.norm(best) > 0.1:
                break
        out[:, k] = best / np.linalg.norm(best)
        if first < k:
            out[:, k] -= out[:, first:k] @ (out[:, first:k].T @ out[:, k])
            out[:, k] /= np.linalg.norm(out[:, k])
    return out


def right_singular(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values, falling, and the right singular vectors as columns."""
    diagonal, upper, v = bidiagonalise(matrix)
    n = len(diagonal)
    scale = max(float(np.max(np.abs(diagonal), initial=0.0)), float(np.max(np.abs(upper), initial=0.0)))
    edges = [0, *[i + 1 for i in range(n - 1) if abs(upper[i]) <= EPS * scale], n]
    values, vectors = np.zeros(n), np.zeros((n, n))
    for start, end in zip(edges[:-1], edges[1:], strict=True):
        own = squared_singular_values(diagonal[start:end], upper[start : end - 1])
        values[start:end] = own
        vectors[start:end, start:end] = _vectors(diagonal[start:end], upper[start : end - 1], own)
    order = np.argsort(-values, kind="stable")
    return values[order], (v @ vectors)[:, order]
