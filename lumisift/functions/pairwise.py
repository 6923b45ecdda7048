"""Distances of blocks of vectors in numpy, with the arithmetic of the column expressions."""

from __future__ import annotations

import numpy as np

from lumisift.errors import QueryError
from lumisift.functions.vectors import LAYOUT_CHANNEL_SIZES, LAYOUT_SCALE, LAYOUT_WEIGHTS, QUANTUM


def _jsd(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Divergence of each row of ``x`` from one query, or from a query of its own, with the arithmetic of the column expression."""
    sx, sq = x.sum(axis=1), q.sum(axis=-1)
    with np.errstate(divide="ignore", invalid="ignore"):
        p, r = x / sx[:, None], q / sq[..., None]
        half = lambda a, b: np.where(a > 0, a * np.log(2.0 * a / (a + b)), 0.0)
        value = np.cumsum(half(p, r) + half(r, p), axis=1)[:, -1] / 2.0
    apart = np.round(np.log(2.0), 6)
    return np.where((sx == 0) & (sq == 0), 0.0, np.where((sx == 0) | (sq == 0), apart, np.round(value, 6)))


def _layout(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    start, out = 0, np.zeros(len(x))
    for size in LAYOUT_CHANNEL_SIZES:
        at = slice(start, start + size)
        out = out + np.sqrt(np.cumsum(((x[:, at] - q[..., at]) / LAYOUT_SCALE) ** 2 * np.array(LAYOUT_WEIGHTS[at]), axis=1)[:, -1])
        start += size
    return np.round(out, 6)


_STEPWISE = {
    "l1": lambda x, q: np.abs(x - q).sum(axis=1),
    "l2": lambda x, q: np.sqrt(((x - q) ** 2).sum(axis=1)) / float(QUANTUM),
    "jsd": _jsd,
    "layout": _layout,
}


def pairwise(metric: str, docs: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """(docs x queries) distances with the arithmetic of the column expressions."""
    x, q = docs.astype(np.float64), queries.astype(np.float64)
    if metric in _STEPWISE:
        return np.stack([_STEPWISE[metric](x, row) for row in q], axis=1)
    ab, aa, bb = x @ q.T, (x * x).sum(axis=1)[:, None], (q * q).sum(axis=1)[None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        if metric == "cosine":
            return 1.0 - ab / np.sqrt(aa * bb)
        if metric == "tanimoto":
            out = 100.0 * (1.0 - ab / (aa + bb - ab))
            return np.where((aa == 0) & (bb == 0), 0.0, np.where((aa == 0) | (bb == 0), 100.0, out))
    raise QueryError(f"metric {metric!r} has no batch form")


def scores(distances: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(distances <= 1, 2.0 - distances, 1.0 / distances)


def paired(metric: str, docs: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """The distance of each row of ``docs`` from the same row of ``queries``; NaN where the metric has none."""
    x, q = docs.astype(np.float64), queries.astype(np.float64)
    if metric in _STEPWISE:
        return _STEPWISE[metric](x, q)
    ab, aa, bb = (np.einsum("ij,ij->i", a, b) for a, b in ((x, q), (x, x), (q, q)))
    with np.errstate(divide="ignore", invalid="ignore"):
        if metric == "cosine":
            return 1.0 - ab / np.sqrt(aa * bb)
        if metric == "tanimoto":
            out = 100.0 * (1.0 - ab / (aa + bb - ab))
            return np.where((aa == 0) & (bb == 0), 0.0, np.where((aa == 0) | (bb == 0), 100.0, out))
    raise QueryError(f"metric {metric!r} has no batch form")
