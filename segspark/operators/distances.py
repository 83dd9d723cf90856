"""Distance matrices of two small blocks of rows, in numpy, for use inside tasks."""

from __future__ import annotations

import numpy as np

METRICS = ("euclidean", "manhattan")


def distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    if metric == "manhattan":
        return _by_rows(a, b, lambda d: np.abs(d).sum(-1))
    aa, bb = (a * a).sum(1)[:, None], (b * b).sum(1)[None, :]
    squared = -2.0 * a @ b.T
    squared += aa
    squared += bb
    return _rooted(squared, a, b, aa, bb)


def _rooted(squared, a, b, aa, bb):
    # The product form loses small distances to rounding: recompute those directly.
    if squared.size and not squared.min() > 1e-6 * (aa.max() + bb.max()):
        i, j = np.nonzero(squared <= 1e-6 * (aa + bb))
        np.maximum(squared, 0.0, out=squared)
        for part in range(0, len(i), 100_000):
            p, q = i[part : part + 100_000], j[part : part + 100_000]
            squared[p, q] = ((a[p] - b[q]) ** 2).sum(1)
    return np.sqrt(squared, out=squared)


def factors(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Left and right factor whose one product holds the squared distances of all rows, for many calls of ``from_factors``."""
    xx, one = (x * x).sum(1)[:, None], np.ones((len(x), 1))
    return np.hstack([-2.0 * x, xx, one]), np.ascontiguousarray(np.hstack([x, one, xx]).T)


def from_factors(left: np.ndarray, right: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows behind a left and a right factor, written into ``room``."""
    squared = np.matmul(left, right, out=room[: left.shape[0] * right.shape[1]].reshape(left.shape[0], -1))
    aa, bb = left[:, -2], right[-1]
    if squared.min() > 1e-6 * (aa.max() + bb.max()):
        return np.sqrt(squared, out=squared)
    return _rooted(squared, left[:, :-2] * -0.5, right[:-2].T, aa[:, None], bb[None, :])


def within(a: np.ndarray, b: np.ndarray, metric: str, radius: float) -> np.ndarray:
    """Which pairs lie within the radius; pairs near it are decided by direct differences."""
    if metric == "manhattan":
        return _within_manhattan(a, b, radius)
    d = distances(a, b, metric)
    near = d <= radius
    i, j = np.nonzero(np.abs(d - radius) <= 1e-6 * max(radius, 1e-12))
    near[i, j] = np.sqrt(((a[i] - b[j]) ** 2).sum(1)) <= radius
    return near


def _within_manhattan(a: np.ndarray, b: np.ndarray, radius: float) -> np.ndarray:
    """Sums in single precision, dimension by dimension; pairs that rounding could decide are summed again in double."""
    rows, width = a.shape
    top = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0), abs(radius))
    if not 1e-30 < top < 1e30:
        return distances(a, b, "manhattan") <= radius
    # Two roundings to single, one difference and the running sum, each at most eps of the largest value so far.
    unsure = 4 * np.finfo("float32").eps * (width + 2) * (2 * top + radius)
    left, right = a.T.astype("float32", order="C"), b.T.astype("float32", order="C")
    near = np.empty((rows, len(b)), dtype=bool)
    step = 128
    gap = np.empty((step, len(b)), "float32")
    for start in range(0, rows, step):
        end = min(rows, start + step)
        total, g = np.zeros((end - start, len(b)), "float32"), gap[: end - start]
        for k in range(width):
            np.subtract(left[k, start:end, None], right[k][None, :], out=g)
            np.abs(g, out=g)
            total += g
        near[start:end] = total <= radius
        i, j = np.nonzero(np.abs(total - np.float32(radius)) <= unsure)
        for part in range(0, len(i), 100_000):
            p, q = start + i[part : part + 100_000], j[part : part + 100_000]
            near[p, q] = np.abs(a[p] - b[q]).sum(1) <= radius
    return near


def _by_rows(a, b, reduce, chunk=250_000):
    step = max(1, chunk // max(1, b.size))
    out = np.empty((len(a), len(b)))
    for s in range(0, len(a), step):
        out[s : s + step] = reduce(a[s : s + step, None, :] - b[None, :, :])
    return out
