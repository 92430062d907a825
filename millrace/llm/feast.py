"""Largest eigenpairs of a symmetric matrix by contour integration, the contour's solves spread over Spark tasks.

The matrix has one row a dimension of the data, so its size is a property of the data and not of their number.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

EPS = np.finfo(float).eps


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and next diagonal of a tridiagonal matrix with the same eigenvalues, by Householder reflections."""
    a, size = matrix.copy(), len(matrix)
    for k in range(size - 2):
        x = a[k + 1:, k].copy()
        norm = np.linalg.norm(x)
        if norm == 0:
            continue
        x[0] += np.copysign(norm, x[0])
        x /= np.linalg.norm(x)
        block = a[k + 1:, k + 1:]
        p = block @ x
        p -= (x @ p) * x
        block -= 2 * (np.outer(x, p) + np.outer(p, x))
        a[k + 1:, k] -= 2 * x * (x @ a[k + 1:, k])
    return np.diagonal(a).copy(), np.diagonal(a, -1).copy()


def count_above(diagonal: np.ndarray, beside: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Inertia: how many eigenvalues lie above each shift, the number of positive pivots of the shifted matrix."""
    small = EPS * max(np.abs(diagonal).max(initial=0), np.abs(beside).max(initial=0)) + np.finfo(float).tiny
    pivot = diagonal[0] - shifts
    above = (pivot > 0).astype(np.int64)
    for d, b in zip(diagonal[1:], beside):
        pivot = np.where(np.abs(pivot) < small, -small, pivot)
        pivot = d - shifts - b * b / pivot
        above += pivot > 0
    return above


def located(diagonal: np.ndarray, beside: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the `most` largest eigenvalues, narrow but for rounding, by bisection on the inertia."""
    radius = np.abs(np.append(beside, 0)) + np.abs(np.append(0, beside))
    low = np.full(most, (diagonal - radius).min())
    high = np.full(most, (diagonal + radius).max())
    pad = EPS * max(abs(low[0]), abs(high[0])) * len(diagonal) + np.finfo(float).tiny
    low, high = low - pad, high + pad
    for _ in range(70):
        middle = (low + high) / 2
        below = count_above(diagonal, beside, middle) > np.arange(most)   # eigenvalue i is above the middle
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return low, high


def intervals(values: np.ndarray, wanted: int, ratio: float = 8.0) -> list[tuple[float, float]]:
    """Intervals that hold the `wanted` largest of the falling `values` and end in gaps between them.

    The lowest end lies in the widest gap, relative to its values, after the wanted ones; an interval goes up until its
    values have grown by `ratio`, so that none is tiny beside another in one contour.
    """
    top = values[0] + (values[0] - values[-1]) * 0.05 + abs(values[0]) * 0.01
    if len(values) > wanted:
        gaps = (values[wanted - 1:-1] - values[wanted:]) / np.maximum(np.abs(values[wanted - 1:-1]), np.finfo(float).tiny)
        last = wanted + int(np.argmax(gaps))
        bottom = (values[last - 1] + values[last]) / 2
    else:
        last = len(values)
        bottom = values[-1] - max(abs(values[-1]) * 0.1, values[0] * EPS * 100)
    found = []
    while last > 0:
        first = last - 1
        while first > 0 and values[first - 1] <= max(values[last - 1], 0) * ratio:
            first -= 1
        while 0 < first < last - 1 and values[first - 1] - values[first] < 1e-6 * values[first]:
            first += 1                                     # not inside a group of nearly equal ones
        end = (values[first - 1] + values[first]) / 2 if first else top
        found.append((bottom, end))
        bottom, last = end, first
    return found


def filtered(spark: SparkSession, matrix: np.ndarray, bases: list[np.ndarray], spans: list[tuple[float, float]],
             nodes: int = 8) -> list[np.ndarray]:
    """Each basis under the spectral projector of its interval, by Gauss quadrature on the upper half of the circle.

    Every quadrature point is one task with one complex solve; what returns has the size of the bases.
    """
    points, weights = np.polynomial.legendre.leggauss(nodes)
    rows = [(i, j) for i in range(len(spans)) for j in range(nodes)]
    held = spark.sparkContext.broadcast((matrix, bases))

    def run(batches):
        whole, start = held.value
        for batch in batches:
            out = []
            for i, j in zip(*[c.to_pylist() for c in batch.columns]):
                low, high = spans[i]
                turn = (high - low) / 2 * np.exp(0.5j * np.pi * (points[j] + 1))
                solved = np.linalg.solve(((low + high) / 2 + turn) * np.eye(len(whole)) - whole, start[i])
                out.append((weights[j] / 2 * (turn * solved).real).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=["i", "j", "part"])

    dealt = spark.createDataFrame(rows, "i int, j int").repartition(len(rows), "i", "j")
    got = sorted((r.i, r.j, r.part) for r in dealt.mapInArrow(run, "i int, j int, part binary").collect())
    held.destroy()
    total = [np.zeros_like(b) for b in bases]
    for i, _, part in got:
        total[i] += np.frombuffer(part).reshape(bases[i].shape)
    return total


def largest(spark: SparkSession, matrix: np.ndarray, wanted: int, rounds: int = 40, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The `wanted` largest eigenvalues, falling, and unit eigenvectors as columns, of a symmetric matrix.

    The inertia of shifted matrices says where the eigenvalues lie and how many each contour holds. A random basis of
    half as many more vectors is filtered and Rayleigh-Ritz extracts pairs, until all that the inertia counts in the
    interval have residuals of rounding size; if some stay missing the basis grows, up to the whole space. The first
    entry of greatest size of a vector is positive.
    """
    size = len(matrix)
    wanted = min(wanted, size)
    if not wanted:
        return np.zeros(0), np.zeros((size, 0))
    bands = tridiagonal(matrix)
    low, high = located(*bands, min(size, 2 * wanted + 1))
    spans = intervals((low + high) / 2, wanted)
    counts = [int(a - b) for a, b in (count_above(*bands, np.array(s)) for s in spans)]
    random, scale = np.random.default_rng(seed), max(abs(high[0]), np.finfo(float).tiny)
    start = lambda m: random.standard_normal((size, min(size, m)))
    bases = [start(c + c // 2 + 4) for c in counts]
    found: list[np.ndarray | None] = [None] * len(spans)
    worst = [np.inf] * len(spans)
    for turn in range(rounds):
        todo = [i for i, f in enumerate(found) if f is None]
        if not todo:
            break
        for i, part in zip(todo, filtered(spark, matrix, [bases[i] for i in todo], [spans[i] for i in todo])):
            u, s, _ = np.linalg.svd(part, full_matrices=False)
            u = u[:, s > s[0] * EPS * size]
            values, turnings = np.linalg.eigh(u.T @ matrix @ u)
            ritz = u @ turnings
            inside = np.flatnonzero((values > spans[i][0]) & (values < spans[i][1]))
            residual = np.linalg.norm(matrix @ ritz[:, inside] - ritz[:, inside] * values[inside], axis=0)
            best = inside[np.argsort(residual)[:counts[i]]]
            rest = np.sort(residual)[:counts[i]].max(initial=0) if len(inside) >= counts[i] else np.inf
            done = rest <= 4 * EPS * scale or (rest <= 64 * EPS * scale * np.sqrt(size) and rest > worst[i] / 4)
            if done and len(inside) == counts[i]:
                found[i] = ritz[:, best]
            elif turn % 8 == 7 or len(inside) < counts[i] and ritz.shape[1] <= counts[i]:
                bases[i], worst[i] = start(2 * bases[i].shape[1]), np.inf   # some stay missing: a wider basis
            else:
                bases[i], worst[i] = np.hstack([ritz, start(bases[i].shape[1] - ritz.shape[1])]), rest
    if any(f is None for f in found):
        raise ArithmeticError("contour integration found fewer eigenpairs than the inertia counts")
    basis, _ = np.linalg.qr(np.hstack(found))
    values, turnings = np.linalg.eigh(basis.T @ matrix @ basis)
    order = np.argsort(-values, kind="stable")[:wanted]
    vectors = (basis @ turnings)[:, order]
    lead = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))]
    return values[order], vectors * np.where(lead < 0, -1.0, 1.0)
