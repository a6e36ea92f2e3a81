"""Gradient-boosted trees for small tables of numeric features (logistic loss)."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Fitted on the driver from a bounded sample, then carried to the workers as plain lists."""

    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.3, cuts: int = 16, least: int = 4):
        self.rounds, self.depth, self.rate, self.cuts, self.least = rounds, depth, rate, cuts, least
        self.base, self.trees = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> "BoostedTrees":
        x, y = np.asarray(x, float), np.asarray(y, float)
        if 0 < y.sum() < len(y):  # the rarer class is repeated, so that both weigh alike
            few = float(y.mean() < 0.5)
            times = np.where(y == few, max(1, round((y != few).sum() / (y == few).sum())), 1)
            x, y = np.repeat(x, times, axis=0), np.repeat(y, times)
        p = min(max(y.mean() if len(y) else 0.5, 1e-3), 1 - 1e-3)
        self.base = float(np.log(p / (1 - p)))
        if not len(y) or y.min() == y.max():
            return self
        grid = [np.unique(np.quantile(x[:, k], np.linspace(0.02, 0.98, self.cuts))) for k in range(x.shape[1])]
        bins = np.column_stack([np.searchsorted(cuts, x[:, k]) for k, cuts in enumerate(grid)])  # v <= cuts[i] where bin <= i
        score = np.full(len(y), self.base)
        for _ in range(self.rounds):
            q = 1 / (1 + np.exp(-score))
            tree = self._grow(bins, y - q, q * (1 - q), grid, np.arange(len(y)), self.depth)
            self.trees.append(tree)
            score += self.rate * _walk(tree, x)
        return self

    def _grow(self, bins, g, h, grid, rows, depth):
        gr, hr = g[rows], h[rows]
        gs, hs = gr.sum(), hr.sum()
        leaf = float(gs / (hs + 1.0))
        if not depth or len(rows) < 2 * self.least:
            return leaf
        best, at = 1e-6, None
        for k, cuts in enumerate(grid):
            b = bins[rows, k]
            size = len(cuts) + 1
            n, gl, hl = (np.cumsum(np.bincount(b, w, size))[:-1] for w in (None, gr, hr))
            gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
            gain[(n < self.least) | (len(rows) - n < self.least)] = 0
            i = int(gain.argmax()) if len(gain) else 0
            if len(gain) and gain[i] > best:
                best, at = gain[i], (k, i)
        if at is None:
            return leaf
        k, i = at
        low = bins[rows, k] <= i
        return (k, float(grid[k][i]), self._grow(bins, g, h, grid, rows[low], depth - 1), self._grow(bins, g, h, grid, rows[~low], depth - 1))

    def score(self, x: np.ndarray) -> np.ndarray:
        x = np.asarray(x, float)
        return self.base + self.rate * sum((_walk(t, x) for t in self.trees), np.zeros(len(x)))


def _walk(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    k, c, low, high = tree
    return np.where(x[:, k] <= c, _walk(low, x), _walk(high, x))
