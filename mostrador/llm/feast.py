"""Leading eigenpairs of a symmetric matrix by contour integration (FEAST), slice by slice.

The wanted end of the spectrum is cut into slices at wide gaps. Within a slice, a
quadrature over a circle around it sums solutions of complex shifted systems, which
projects a random block onto the slice's eigenvectors; Rayleigh-Ritz extracts them, and the
projection is repeated until they are exact to rounding. How many eigenvalues a slice
holds is known beforehand from inertia: the negative pivots of the shifted matrix in
tridiagonal form. A slice is done only when it has as many pairs as that count.
A circle may be far wider than the eigenvalues of its slice, with others crowded just outside it, which the
quadrature damps little. A slice that does not settle for this reason is solved again, on a circle close around
its eigenvalues and with a block that has room for those just outside; all others then fall by hundreds in a step.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

NODES = 8  # of the upper half of the circle
MOST_STEPS = 40
SLICE = 8  # eigenvalues to a slice, more only where they lie too close to be parted
NEAR = 1.5  # radii of the circle within which eigenvalues count as just outside it
_CLEAR = 1e-6  # the gap, as a share of the largest eigenvalue, that slices are parted at
_EPS = np.finfo(float).eps


class Slice(NamedTuple):
    """An interval of the spectrum, the number of eigenvalues in it, a closer interval around them, and how many are in or ``NEAR`` that."""

    low: float
    high: float
    count: int
    close_low: float
    close_high: float
    near: int


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix with the same eigenvalues, by Householder reflections."""
    a = np.array(matrix, float)
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1 :, k]
        norm = np.linalg.norm(x)
        if norm == 0.0:
            continue
        v = x.copy()
        v[0] += np.copysign(norm, v[0])
        v /= np.linalg.norm(v)
        part = a[k + 1 :, k:]
        part -= 2.0 * np.outer(v, v @ part)
        part = a[k:, k + 1 :]
        part -= 2.0 * np.outer(part @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def counts_above(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues exceed each shift: the positive pivots of the shifted tridiagonal matrix."""
    tiny = np.finfo(float).tiny / _EPS
    above = np.zeros(len(shifts), int)
    pivot = np.ones(len(shifts))
    squares = np.concatenate([[0.0], off * off])
    with np.errstate(over="ignore"):
        for d, e in zip(diagonal, squares):
            pivot = (d - shifts) - e / pivot
            pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
            above += pivot > 0
    return above


def bounds(diagonal: np.ndarray, off: np.ndarray) -> tuple[float, float]:
    """An interval that holds all eigenvalues (Gershgorin)."""
    reach = np.abs(np.concatenate([[0.0], off])) + np.abs(np.concatenate([off, [0.0]]))
    return float((diagonal - reach).min()), float((diagonal + reach).max())


def slices(diagonal: np.ndarray, off: np.ndarray, wanted: int) -> list[Slice]:
    """Disjoint slices from the top down that hold at least the ``wanted`` largest positive eigenvalues."""
    n = len(diagonal)
    low, high = bounds(diagonal, off)
    scale = max(abs(low), abs(high))
    nothing = 8 * n * _EPS * scale  # what rounding makes of an eigenvalue of zero
    wanted = min(wanted, int(counts_above(diagonal, off, np.array([nothing]))[0]))
    if wanted == 0:
        return []
    # All eigenvalues, roughly, by bisection of the counts.
    ranks = np.arange(1, n + 1)
    left, right = np.full(n, low - scale * _EPS), np.full(n, high + scale * _EPS)
    for _ in range(44):
        middle = (left + right) / 2
        enough = counts_above(diagonal, off, middle) >= ranks
        left, right = np.where(enough, middle, left), np.where(enough, right, middle)
    values = (left + right) / 2
    gaps = np.append(values[:-1] - values[1:], np.inf)
    known, beyond = values, max(values[0] - values[-1], scale * 1e-3)
    values = np.append(values, values[-1] - beyond)
    clear = np.flatnonzero(gaps > _CLEAR * scale)
    # Eigenvalues beyond the wanted ones come along where they cannot be parted from them.
    stop = int(clear[clear >= wanted - 1][0]) + 1
    edges, close, start = [float(values[0] + max(values[0] - values[stop], scale * 1e-3))], [], 0
    while start < stop:
        end = start + int(np.argmax(gaps[start : min(start + SLICE, stop)])) + 1
        if gaps[end - 1] <= _CLEAR * scale:  # a cluster larger than a slice should be
            end = int(clear[clear >= start][0]) + 1
        edges.append(float((values[end - 1] + values[end]) / 2))
        room = min(gaps[start - 1] if start else beyond, gaps[end - 1], beyond) / 2
        low, high = float(known[end - 1] - room), float(known[start] + room)
        close.append((low, high, int((np.abs(known - (low + high) / 2) < NEAR * (high - low) / 2).sum())))
        start = end
    above = counts_above(diagonal, off, np.array(edges))
    return [Slice(b, a, int(m - k), *c) for a, b, k, m, c in zip(edges, edges[1:], above, above[1:], close) if m > k]


def _settled(matrix: np.ndarray, low: float, high: float, count: int, width: int, seed: int) -> tuple[np.ndarray, np.ndarray] | None:
    """The ``count`` eigenpairs between two bounds by a block of ``width`` vectors; None if they do not settle."""
    n = len(matrix)
    scale = float(np.abs(matrix).sum(axis=1).max())
    center, radius = (low + high) / 2, (high - low) / 2
    angles = (np.arange(NODES) + 0.5) * np.pi / NODES
    points = center + radius * np.exp(1j * angles)
    block = np.random.default_rng(seed).standard_normal((n, min(n, width)))
    identity = np.eye(n)
    best = None
    for _ in range(MOST_STEPS):
        filtered = np.zeros_like(block)
        for z in points:
            filtered += ((z - center) * np.linalg.solve(z * identity - matrix, block.astype(complex))).real / NODES
        # Rayleigh-Ritz. Directions the projection has all but removed are noise, and harmless ones.
        basis, _ = np.linalg.qr(filtered)
        values, rotation = np.linalg.eigh(basis.T @ matrix @ basis)
        block = basis @ rotation
        errors = np.linalg.norm(matrix @ block - block * values, axis=0)
        inside = np.flatnonzero((values > low) & (values < high) & (errors <= 64 * n * _EPS * scale))
        if len(inside) == count:
            if best is not None:  # once more after it has settled, down to rounding
                return values[inside], block[:, inside]
            best = inside
    return None


def solve_slice(matrix: np.ndarray, part: Slice, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and unit eigenvectors (columns) of the slice, as many as its count says."""
    wide = part.low, part.high, part.count, max(part.count + 4, int(1.5 * part.count))
    close = part.close_low, part.close_high, part.count, part.near + 4
    for low, high, count, width in (wide, close):
        found = _settled(matrix, low, high, count, width, seed)
        if found is not None:
            return found
    raise RuntimeError(f"eigenvalues between {part.low} and {part.high} did not settle: {part.count} are there")
