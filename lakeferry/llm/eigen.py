"""Leading eigenvalues and eigenvectors of a symmetric matrix: Householder reflections, Sturm counts, inverse iteration."""

from __future__ import annotations

import numpy as np

#: Eigenvalues closer than this share of the norm are a cluster, whose vectors are made orthogonal to each other.
CLUSTER = 1e-3
_EPS = np.finfo(float).eps
_ROUNDS = 12


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, off-diagonal, reflectors) of the tridiagonal matrix similar to a symmetric one.

    Reflector k is a unit vector over the places from k + 1 on, or empty where that column was tridiagonal already.
    """
    a = np.array(matrix, float)
    size = len(a)
    reflectors = []
    for k in range(size - 2):
        x = a[k + 1 :, k].copy()
        scale = np.abs(x).max()
        if not np.abs(x[1:]).max() > 0:
            reflectors.append(np.empty(0))
            continue
        x /= scale
        length = np.sqrt(x @ x)
        first = -length if x[0] >= 0 else length
        x[0] -= first
        v = x / np.sqrt(x @ x)
        block = a[k + 1 :, k + 1 :]
        p = block @ v
        w = 2 * (p - (v @ p) * v)
        block -= np.outer(v, w) + np.outer(w, v)
        a[k + 1 :, k] = a[k, k + 1 :] = 0
        a[k + 1, k] = a[k, k + 1] = first * scale
        reflectors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def counts_below(diagonal: np.ndarray, off: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues of the tridiagonal matrix are less than each point."""
    least = np.finfo(float).tiny * max(1.0, float((off**2).max(initial=0.0)))
    q = diagonal[0] - points
    below = (q < 0).astype(np.int64)
    for d, e in zip(diagonal[1:], off, strict=True):
        q = d - points - e * e / np.where(np.abs(q) < least, -least, q)
        below += q < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` largest eigenvalues in falling order, each bisected until its bounds are neighbouring doubles."""
    reach = np.concatenate(([0.0], np.abs(off))) + np.concatenate((np.abs(off), [0.0]))
    span = float(np.abs(diagonal).max() + reach.max()) * (1 + 4 * _EPS) + np.finfo(float).tiny
    place = len(diagonal) - 1 - np.arange(n)
    low, high = np.full(n, -span), np.full(n, span)
    while True:
        middle = low + (high - low) / 2
        if not ((middle > low) & (middle < high) & (high - low > _EPS * span / 64)).any():
            return middle
        above = counts_below(diagonal, off, middle) <= place
        low, high = np.where(above, middle, low), np.where(above, high, middle)


def _factored(diagonal: np.ndarray, off: np.ndarray, value: float, least: float):
    """LU factors with row exchanges of the tridiagonal matrix minus ``value``; zero pivots become ``least``."""
    size = len(diagonal)
    main, upper, second = diagonal - value, np.append(off, 0.0), np.zeros(size)
    below, swapped = np.zeros(size), np.zeros(size, bool)
    for i in range(size - 1):
        under, next_main, next_upper = off[i], main[i + 1], upper[i + 1]
        if abs(under) > abs(main[i]):
            swapped[i] = True
            factor = main[i] / under
            main[i + 1] = upper[i] - factor * next_main
            upper[i + 1] = -factor * next_upper
            main[i], upper[i], second[i] = under, next_main, next_upper
        else:
            if abs(main[i]) < least:
                main[i] = least
            factor = under / main[i]
            main[i + 1] = next_main - factor * upper[i]
        below[i] = factor
    if abs(main[-1]) < least:
        main[-1] = least
    return main, upper, second, below, swapped


def _solved(factors, right: np.ndarray) -> np.ndarray:
    main, upper, second, below, swapped = factors
    x = right.copy()
    for i in range(len(x) - 1):
        if swapped[i]:
            x[i], x[i + 1] = x[i + 1], x[i]
        x[i + 1] -= below[i] * x[i]
    for i in range(len(x) - 1, -1, -1):
        if i + 2 < len(x):
            x[i] -= second[i] * x[i + 2]
        if i + 1 < len(x):
            x[i] -= upper[i] * x[i + 1]
        x[i] /= main[i]
    return x


def vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors as rows, by inverse iteration; vectors of a cluster of values are made orthogonal each round."""
    size = len(diagonal)
    reach = np.concatenate(([0.0], np.abs(off))) + np.concatenate((np.abs(off), [0.0]))
    norm = float((np.abs(diagonal) + reach).max()) or 1.0
    least, rng = _EPS * norm, np.random.default_rng(1)
    found = np.empty((len(values), size))
    start, last = 0, np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * norm:
            start = k
        # equal values would give the same vector again and again
        used = min(value, last - 2 * least) if k > start else value
        last = used
        factors = _factored(diagonal, off, used, least)
        x = rng.uniform(-1, 1, size)
        grown = 0
        for _ in range(_ROUNDS):
            x = _solved(factors, x / np.abs(x).max())
            for _ in range(2):
                x -= found[start:k].T @ (found[start:k] @ x)
            length = np.sqrt(x @ x)
            x /= length
            # the solution of a vector of entries up to 1 is this long once the start no longer matters
            grown += length * least * 10 > 1 / np.sqrt(size)
            if grown > 2:
                break
        found[k] = x
    return found


def leading(matrix: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors) of the ``n`` largest eigenvalues in falling order; vectors are rows of length 1."""
    scale = float(np.abs(matrix).max()) or 1.0
    diagonal, off, reflectors = tridiagonal(matrix / scale)
    values = leading_values(diagonal, off, n)
    rows = vectors(diagonal, off, values)
    for k in range(len(reflectors) - 1, -1, -1):
        v = reflectors[k]
        if len(v):
            rows[:, k + 1 :] -= 2 * np.outer(rows[:, k + 1 :] @ v, v)
    return values * scale, rows / np.sqrt((rows * rows).sum(axis=1))[:, None]
