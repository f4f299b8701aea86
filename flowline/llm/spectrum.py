"""Leading eigenvalues of a symmetric matrix by spectrum slicing.

The inertia of A - s I, read off its LDL' factors, says how many eigenvalues lie
above s. Bisection on such counts encloses the k-th largest one alone; a
Rayleigh quotient iteration then converges cubically to it. Counts on both
sides of what was found certify its number; a quotient that has left its
enclosure is started again from a narrower one.
"""

from __future__ import annotations

import numpy as np

#: Bunch and Kaufman's constant, at which both kinds of pivots let factors grow alike.
_ALPHA = (1 + 17**0.5) / 8
_EPS = np.finfo(float).eps


def count_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of ``matrix`` exceed ``shift``: positive pivots of its shifted LDL' factorisation.

    Pivots are single or in twos (Bunch and Kaufman), so that factors stay small
    for an indefinite matrix. A pivot of nothing but rounding counts as none above.
    """
    a = matrix - shift * np.eye(len(matrix))
    tiny = _EPS * max(1e-300, np.abs(a).max()) * len(a)
    positive = 0
    while len(a):
        below = np.abs(a[1:, 0])
        largest = below.max(initial=0.0)
        if max(abs(a[0, 0]), largest) <= tiny:
            a = a[1:, 1:]
            continue
        swap, two = 0, False
        if abs(a[0, 0]) < _ALPHA * largest:
            r = 1 + int(below.argmax())
            others = np.abs(a[r])
            others[r] = 0
            spread = others.max()
            if abs(a[0, 0]) * spread < _ALPHA * largest**2:
                two = abs(a[r, r]) < _ALPHA * spread
                swap = r
        if two:
            order = [0, swap, *[i for i in range(1, len(a)) if i != swap]]
            a = a[np.ix_(order, order)]
            block, side = a[:2, :2], a[2:, :2]
            # A pair of pivots is taken only where its determinant is negative: one eigenvalue on each side.
            positive += 1
            a = a[2:, 2:] - side @ np.linalg.solve(block, side.T)
        else:
            if swap:
                order = [swap, *[i for i in range(len(a)) if i != swap]]
                a = a[np.ix_(order, order)]
            positive += a[0, 0] > 0
            a = a[1:, 1:] - np.outer(a[1:, 0], a[1:, 0] / a[0, 0])
        a = (a + a.T) / 2
    return int(positive)


def _enclose(matrix: np.ndarray, k: int, low: float, high: float, narrow: float) -> tuple[float, float, bool]:
    """An interval with the k-th largest eigenvalue, and whether it is alone in it."""
    above_low, above_high = count_above(matrix, low), count_above(matrix, high)
    while high - low > narrow:
        if above_low - above_high == 1:
            return low, high, True
        middle = (low + high) / 2
        if not low < middle < high:
            break
        above = count_above(matrix, middle)
        if above >= k:
            low, above_low = middle, above
        else:
            high, above_high = middle, above
    return low, high, above_low - above_high == 1


def _iterate(matrix: np.ndarray, shift: float, start: np.ndarray, found: np.ndarray) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration, kept at right angles to the vectors in the rows of ``found``."""
    vector, value = start, shift
    scale = max(np.abs(matrix).max(), 1e-300)
    best = (np.inf, value, vector)
    for _ in range(40):
        shifted = matrix - value * np.eye(len(matrix))
        try:
            solved = np.linalg.solve(shifted, vector)
        except np.linalg.LinAlgError:
            solved = np.linalg.solve(shifted + 4 * _EPS * scale * np.eye(len(matrix)), vector)
        solved = solved / max(np.abs(solved).max(), 1e-300)
        for _ in range(2):
            solved = solved - found.T @ (found @ solved)
        size = np.linalg.norm(solved)
        if not np.isfinite(size) or size == 0:
            break
        vector = solved / size
        value = float(vector @ matrix @ vector)
        residual = float(np.linalg.norm(matrix @ vector - value * vector))
        if residual >= best[0] / 2 and best[0] <= 64 * _EPS * scale * len(matrix):
            break
        if residual < best[0]:
            best = (residual, value, vector)
    return best[1], best[2]


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues in falling order and their unit vectors as rows.

    Each vector's entry of largest size is positive. Equal eigenvalues get any
    vectors at right angles. Every number is certified by counts: fewer than k
    eigenvalues lie above the k-th found plus the rounding it carries, at least
    k above it less that.
    """
    size = len(matrix)
    count = min(count, size)
    values, vectors = np.zeros(count), np.zeros((count, size))
    if not count:
        return values, vectors
    scale = float(np.abs(matrix).max())
    if scale == 0:
        return values, np.eye(size)[:count]
    radius = float(np.abs(matrix).sum(axis=1).max())
    rounding = 16 * _EPS * radius * size
    for k in range(1, count + 1):
        found = vectors[: k - 1]
        low, high, alone = _enclose(matrix, k, -radius - rounding, radius + rounding, rounding)
        start = np.cos(np.arange(1.0, size + 1) * k)
        while True:
            start = start - found.T @ (found @ start)
            value, vector = _iterate(matrix, (low + high) / 2, start / np.linalg.norm(start), found)
            if count_above(matrix, value + rounding) < k <= count_above(matrix, value - rounding):
                break
            if high - low <= rounding:
                raise ArithmeticError(f"eigenvalue number {k} is not certified")
            # The quotient went to a neighbour: halve the enclosure, which brings the start nearer.
            middle = (low + high) / 2
            low, high = (middle, high) if count_above(matrix, middle) >= k else (low, middle)
        values[k - 1] = value
        vectors[k - 1] = vector if vector[np.abs(vector).argmax()] > 0 else -vector
    return values, vectors
