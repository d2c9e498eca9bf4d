"""Forests and boosted trees over counted cells (M3, M4, M6).

Trees see a column only through its bins (at most ``BINS``, as MLlib's
``maxBins``), so rows with the same bins and label are one cell with a count. A
table of cells is bounded by the bins, whatever the number of rows; all trees of
all settings are grown from it. Bootstrap counts are Poisson draws for each row of
a cell (a Poisson draw of the cell's count).
"""

from __future__ import annotations

import numpy as np

BINS = 32
SUMMARY = 512  # quantiles of a column that a task sends


def quantiles(values: np.ndarray, weights: np.ndarray, size: int = SUMMARY) -> np.ndarray:
    """``size`` values, each standing for the same share of the weight."""
    order = np.argsort(values, kind="stable")
    total = np.cumsum(weights[order])
    at = np.searchsorted(total, (np.arange(size) + 0.5) / size * total[-1])
    return values[order][np.minimum(at, len(values) - 1)]


def joined(parts: list[tuple[np.ndarray, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Values and weights of parts that stand for some rows each."""
    return np.concatenate([v for v, _ in parts]), np.concatenate([np.full(len(v), n / len(v)) for v, n in parts])


def splits(values: np.ndarray, weights: np.ndarray, bins: int = BINS) -> np.ndarray:
    """At most ``bins - 1`` cuts, midway between values; a row is left of a cut if it is not above it."""
    seen = np.unique(values)
    low = seen[:-1]
    if len(seen) > bins:
        order = np.argsort(values, kind="stable")
        total = np.cumsum(weights[order])
        low = np.unique(values[order][np.searchsorted(total, np.arange(1, bins) / bins * total[-1])])
        low = low[low < seen[-1]]
    return (low + seen[np.searchsorted(seen, low, side="right")]) / 2


def bin_codes(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """One number for the bins of a row."""
    code = np.zeros(len(x), np.int64)
    for j, c in enumerate(cuts):
        code = code * BINS + np.searchsorted(c, x[:, j], side="left")
    return code


def bins_of(codes: np.ndarray, width: int) -> np.ndarray:
    return np.stack([codes // BINS ** (width - 1 - j) % BINS for j in range(width)], axis=1)


def _grow(bins: np.ndarray, stats: np.ndarray, counts: np.ndarray, score, depth: int, subset: int, rng) -> np.ndarray:
    """The leaf of each cell. ``score(stats)`` falls with the impurity of a node and is summed over its children."""
    cells, width = bins.shape
    node = np.zeros(cells, np.int64)
    every = np.column_stack([stats, counts])
    for _ in range(depth):
        names, node = np.unique(node, return_inverse=True)
        n = len(names)
        hist = np.stack([np.stack([np.bincount(node * BINS + bins[:, j], every[:, s], n * BINS).reshape(n, BINS) for s in range(every.shape[1])], -1) for j in range(width)], 1)
        left = hist.cumsum(2)                         # node, column, bin, statistic
        right = left[:, :, -1:] - left
        gain = score(left) + score(right) - score(left[:, :, -1:])
        whole = np.maximum(left[:, :1, -1:, -1], 1)
        allowed = (left[..., -1] > 0) & (right[..., -1] > 0) & (gain > 1e-12 * whole)
        if subset < width:  # columns of a node, drawn anew for each
            allowed &= (rng.random((n, width)).argsort(1).argsort(1) < subset)[:, :, None]
        gain = np.where(allowed, gain, -np.inf).reshape(n, -1)
        best = gain.argmax(1)
        cut = np.isfinite(gain[np.arange(n), best])
        if not cut.any():
            return node
        column, at = best // BINS, best % BINS
        node = 2 * node + (cut[node] & (bins[np.arange(cells), column[node]] > at[node]))
    return np.unique(node, return_inverse=True)[1]


def _gini(t: np.ndarray) -> np.ndarray:
    return (t[..., 0] ** 2 + t[..., 1] ** 2) / np.maximum(t[..., -1], 1e-300)


def _variance(t: np.ndarray) -> np.ndarray:
    return t[..., 0] ** 2 / np.maximum(t[..., -1], 1e-300)


def forest(bins: np.ndarray, n: np.ndarray, numTrees: int = 20, maxDepth: int = 5, seed: int = 42) -> np.ndarray:
    """M3: the class of each cell; ``n`` holds its rows of class 0 and 1 (both 0: no part in the fit)."""
    rng, votes = np.random.default_rng(seed), np.zeros((len(bins), 2))
    for _ in range(numTrees):
        drawn = rng.poisson(n).astype(np.float64)
        leaf = _grow(bins, drawn, drawn.sum(1), _gini, maxDepth, int(np.ceil(np.sqrt(bins.shape[1]))), rng)
        of = np.stack([np.bincount(leaf, drawn[:, c]) for c in (0, 1)], 1)
        votes += (of / np.maximum(of.sum(1, keepdims=True), 1))[leaf]
    return (votes[:, 1] > votes[:, 0]).astype(np.int8)


def boosted(bins: np.ndarray, n: np.ndarray, maxIter: int = 20, maxDepth: int = 3, stepSize: float = 0.1, seed: int = 42) -> np.ndarray:
    """M4: the class of each cell by trees on the gradients of the logistic loss, the first on the labels."""
    score, counts = np.zeros(len(bins)), n.sum(1).astype(np.float64)
    for i in range(maxIter):
        # 4 y / (1 + exp(2 y F)) for y = -1, 1
        r = np.array([-1.0, 1.0]) if i == 0 else np.stack([-4 / (1 + np.exp(-2 * score)), 4 / (1 + np.exp(2 * score))], 1)
        total = (n * r).sum(1)
        leaf = _grow(bins, total[:, None], counts, _variance, maxDepth, bins.shape[1], None)
        score += (1.0 if i == 0 else stepSize) * (np.bincount(leaf, total) / np.maximum(np.bincount(leaf, counts), 1))[leaf]
    return (score > 0).astype(np.int8)
