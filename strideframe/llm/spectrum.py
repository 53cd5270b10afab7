"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

The signs of D in L D L^T of A - s I count the eigenvalues above s. Bisection with such counts isolates each wanted
eigenvalue; Rayleigh quotient iteration from inside its interval then converges cubically; counts on both sides of the
result certify its number. A step that leaves the interval makes the interval smaller and starts again. Eigenvalues closer
together than rounding form one cluster, whose vectors are kept orthogonal to one another.

One factorization of a d x d matrix costs about d^3 / 3 steps and 8 d^2 bytes; a wanted eigenvalue takes some twenty.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_EPS = float(np.finfo(np.float64).eps)
#: Bunch and Kaufman's pivot bound, (1 + sqrt 17) / 8
_PIVOT = 0.6403882032022076


@dataclass
class Factors:
    """P (A - s I) P^T = L D L^T with diagonal blocks of one or two rows."""

    order: np.ndarray
    lower: np.ndarray
    blocks: list[tuple[int, int]]
    diagonal: np.ndarray
    above: int

    def solve(self, right: np.ndarray) -> np.ndarray:
        y = right[self.order].astype(np.float64)
        n = len(y)
        for k in range(n):
            y[k + 1 :] -= self.lower[k + 1 :, k] * y[k]
        for at, width in self.blocks:
            if width == 1:
                y[at] /= self.diagonal[at, at]
            else:
                y[at : at + 2] = np.linalg.solve(self.diagonal[at : at + 2, at : at + 2], y[at : at + 2])
        for k in range(n - 1, -1, -1):
            y[k] -= self.lower[k + 1 :, k] @ y[k + 1 :]
        out = np.empty(n)
        out[self.order] = y
        return out


def factor(matrix: np.ndarray, shift: float, least: float) -> Factors:
    """L D L^T of ``matrix - shift I`` with diagonal pivoting; a pivot of no size counts as ``least``."""
    a = matrix - shift * np.eye(len(matrix))
    n = len(a)
    order, lower, diagonal = np.arange(n), np.eye(n), np.zeros((n, n))
    blocks, above, k = [], 0, 0

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]
            lower[[i, j], :k] = lower[[j, i], :k]
            order[[i, j]] = order[[j, i]]

    while k < n:
        width = 1
        if k + 1 < n:
            column = np.abs(a[k + 1 :, k])
            r = int(column.argmax()) + k + 1
            most = column[r - k - 1]
            if abs(a[k, k]) < _PIVOT * most:
                row = np.abs(a[r, k:])
                row[r - k] = 0
                other = row.max()
                if abs(a[k, k]) * other >= _PIVOT * most * most:
                    pass
                elif abs(a[r, r]) >= _PIVOT * other:
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    width = 2
        rest = slice(k + width, n)
        if width == 1:
            pivot = a[k, k] if abs(a[k, k]) > least else least
            diagonal[k, k] = pivot
            above += pivot > 0
            steps = a[rest, k] / pivot
            lower[rest, k] = steps
            a[rest, rest] -= np.outer(steps, a[k, rest])
        else:
            block = a[k : k + 2, k : k + 2].copy()
            diagonal[k : k + 2, k : k + 2] = block
            above += 1  # such a block has a negative determinant: one eigenvalue of each sign
            steps = np.linalg.solve(block, a[k : k + 2, rest]).T
            lower[rest, k : k + 2] = steps
            a[rest, rest] -= steps @ a[k : k + 2, rest]
        blocks.append((k, width))
        k += width
    return Factors(order, lower, blocks, diagonal, int(above))


def leading_pairs(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit eigenvectors as columns (largest entry positive)."""
    matrix = np.asarray(matrix, np.float64)
    n = len(matrix)
    wanted = min(wanted, n)
    radius = np.abs(matrix).sum(1) - np.abs(np.diag(matrix))
    size = float(np.abs(matrix).sum(1).max(initial=0))
    values, vectors = np.zeros(wanted), np.zeros((n, wanted))
    if not size:
        vectors[:wanted] = np.eye(wanted)
        return values, vectors
    least, close = _EPS * size * 1e-3, 4 * _EPS * size
    low = float((np.diag(matrix) - radius).min()) - close
    high = float((np.diag(matrix) + radius).max()) + close
    counts: dict[float, int] = {low: n, high: 0}

    def above(shift: float) -> int:
        if shift not in counts:
            counts[shift] = factor(matrix, shift, least).above
        return counts[shift]

    for k in range(wanted):
        # the narrowest known interval with more than k eigenvalues above its lower end and at most k above its upper end
        low = max(s for s, c in counts.items() if c > k)
        high = min(s for s, c in counts.items() if c <= k and s > low)
        start = np.cos(np.arange(1, n + 1) * (k + 1.0)) + 1.5  # a fixed start with parts along all directions
        while True:
            while (counts[low] > k + 1 or counts[high] < k) and high - low > close:
                middle = (low + high) / 2
                low, high = (middle, high) if above(middle) > k else (low, middle)
            value, vector = _rayleigh(matrix, low, high, vectors[:, :k], start, least, size)
            if low - close <= value <= high + close or high - low <= close:
                break
            middle = (low + high) / 2
            low, high = (middle, high) if above(middle) > k else (low, middle)
        # certify the number: more than k above a little less than the value, at most k above a little more
        slack = close * max(1.0, np.sqrt(n))
        if not (above(value - slack) > k >= above(value + slack)):
            raise ArithmeticError(f"eigenvalue {k + 1} could not be certified")
        values[k] = value
        vectors[:, k] = vector if vector[np.abs(vector).argmax()] > 0 else -vector
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def _rayleigh(
    matrix: np.ndarray, low: float, high: float, known: np.ndarray, start: np.ndarray, least: float, size: float
) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration, begun with two steps at the middle of the interval."""

    def unit(x: np.ndarray) -> np.ndarray:
        for _ in range(2):  # twice is enough against rounding
            x = x - known @ (known.T @ x)
            x = x / np.linalg.norm(x)
        return x

    vector, shift, best = unit(start), (low + high) / 2, None
    for step in range(40):
        vector = unit(factor(matrix, shift, least).solve(vector))
        value = float(vector @ (matrix @ vector))
        gap = float(np.linalg.norm(matrix @ vector - value * vector))
        if best is None or gap < best[0]:
            best = (gap, value, vector)
        elif step > 4:  # no longer smaller: as exact as rounding allows
            break
        if gap <= _EPS * size:
            break
        if step:
            shift = value
    return best[1], best[2]
