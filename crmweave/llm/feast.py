"""Largest eigenvalues and eigenvectors of a symmetric matrix by contour integration over slices of the spectrum.

The number of eigenvalues above a point is the inertia of the shifted matrix, read off the pivots of a symmetric
factorisation. Bisection by such counts cuts the upper spectrum into slices of a few eigenvalues each. A slice is solved
on its own: a quadrature of shifted solves along a circle around it filters a random block towards its eigenspace,
Rayleigh-Ritz takes the pairs out, and the block is filtered again until as many pairs have converged inside the slice as
the inertia counts say. Where they stay fewer, the block is doubled.
"""

from __future__ import annotations

from functools import cache

import numpy as np

NODES = 8  # of the quadrature on the upper half of the circle
ROUNDS = 25
PAIRS_A_SLICE = 8
EPS = np.finfo(float).eps
PIVOT = (1 + 17**0.5) / 8  # bounds the growth of both kinds of pivots


def inertia(matrix: np.ndarray, shift: float) -> tuple[int, int]:
    """Numbers of eigenvalues above the shift and, to rounding, at it."""
    left = matrix - shift * np.eye(len(matrix))
    tiny = len(left) * EPS * (np.abs(left).max(initial=0.0) + abs(shift))
    above = 0
    while n := len(left):
        size = np.abs(left)
        k = int(np.argmax(np.diagonal(size)))
        i, j = np.unravel_index(int(np.argmax(size - np.diag(np.diagonal(size)))), size.shape) if n > 1 else (0, 0)
        if size[k, k] >= PIVOT * (size[i, j] if i != j else 0.0):
            if size[k, k] <= tiny:
                return above, n
            above += int(left[k, k] > 0)
            rest = np.arange(n) != k
            side = left[rest, k]
            left = left[np.ix_(rest, rest)] - np.outer(side, side) / left[k, k]
        else:  # a block of two with a negative determinant: one eigenvalue on each side
            above += 1
            rest = np.ones(n, bool)
            rest[[i, j]] = False
            side = left[np.ix_(rest, [i, j])]
            left = left[np.ix_(rest, rest)] - side @ np.linalg.solve(left[np.ix_([i, j], [i, j])], side.T)
    return above, 0


def slices(matrix: np.ndarray, wanted: int, most: int = PAIRS_A_SLICE) -> list[tuple[float, float, int]]:
    """(low, high, count) from the top down, disjoint, with the ``wanted`` largest eigenvalues of a nonnegative matrix.

    A slice has at most ``most`` of them, or is too narrow to be cut.
    """
    n, top = len(matrix), 1.001 * float(np.abs(matrix).sum(axis=1).max(initial=0.0))

    @cache
    def above(x: float) -> int:
        return inertia(matrix, x)[0]

    out, found, open_ = [], 0, [(-1e-3 * top, top, n)] if top else []  # a zero matrix has no positive ones
    while open_ and found < wanted:
        low, high, count = open_.pop()
        if not count:
            continue
        if count <= most or high - low <= 1e-7 * top:
            out.append((low, high, count))
            found += count
            continue
        cut = low + 0.4871 * (high - low)
        while inertia(matrix, cut)[1]:  # not through an eigenvalue
            cut += 0.0173 * (high - low)
        upper = above(cut) - (above(high) if high < top else 0)
        open_ += [(low, cut, count - upper), (cut, high, upper)]
    return out


def eigenpairs(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues between low and high, and their unit eigenvectors as columns."""
    n, scale = len(matrix), float(np.linalg.norm(matrix, 2))
    at, weight = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(-0.5j * np.pi * (at - 1))
    middle, radius = (low + high) / 2, (high - low) / 2
    size = min(n, 2 * count + 4)
    while True:
        block = np.random.Generator(np.random.PCG64(size)).standard_normal((n, size))
        for _ in range(ROUNDS):
            filtered = np.zeros((n, size))
            for t, w in zip(turn, weight, strict=True):
                filtered += w / 2 * (radius * t * np.linalg.solve((middle + radius * t) * np.eye(n) - matrix, block.astype(complex))).real
            basis = np.linalg.qr(filtered)[0]
            values, small = np.linalg.eigh(basis.T @ matrix @ basis)
            block = basis @ small
            left = np.linalg.norm(matrix @ block - block * values, axis=0)
            inside = (values > low) & (values < high) & (left <= 32 * n**0.5 * EPS * scale)
            if inside.sum() == count:
                return values[inside], block[:, inside]
        if size == n:
            raise ArithmeticError(f"{inside.sum()} of {count} eigenvalues between {low} and {high} converged")
        size = min(n, 2 * size)
