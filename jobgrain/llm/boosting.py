"""Gradient-boosted trees for a yes-or-no question, on binned features."""

from __future__ import annotations

import numpy as np

BINS = 32


class Boosted:
    """Trees of equal depth as flat arrays: per tree and inner node a feature and the bin
    up to which a row goes left, per leaf a value."""

    def __init__(self, edges, features, bins, leaves, constant):
        self.edges, self.features, self.bins = edges, features, bins
        self.leaves, self.constant = leaves, constant

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, trees=80, depth=5, rate=0.2, least=3.0, ridge=1.0):
        """x: rows by features; y: 0 or 1."""
        shares = np.linspace(0, 1, BINS + 1)[1:-1]
        edges = [np.unique(np.quantile(x[:, f], shares)) for f in range(x.shape[1])]
        binned = cls._bin(x, edges)
        mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        constant = float(np.log(mean / (1 - mean)))
        margin = np.full(len(y), constant)
        inner = (1 << depth) - 1
        features = np.zeros((trees, inner), dtype=np.int32)
        bins = np.full((trees, inner), BINS, dtype=np.int32)
        leaves = np.zeros((trees, 1 << depth))
        for tree in range(trees):
            p = 1 / (1 + np.exp(-margin))
            gradient, weight = p - y, np.maximum(p * (1 - p), 1e-6)
            node = np.zeros(len(y), dtype=np.int64)  # inside the level
            for level in range(depth):
                n = 1 << level
                gains = np.full((n, x.shape[1], BINS), -np.inf)
                for f in range(x.shape[1]):
                    cell = node * BINS + binned[:, f]
                    g = np.bincount(cell, gradient, n * BINS).reshape(n, BINS).cumsum(axis=1)
                    h = np.bincount(cell, weight, n * BINS).reshape(n, BINS).cumsum(axis=1)
                    left, right = h, h[:, -1:] - h
                    gain = g**2 / (left + ridge) + (g[:, -1:] - g) ** 2 / (right + ridge)
                    gain -= g[:, -1:] ** 2 / (h[:, -1:] + ridge)
                    gains[:, f] = np.where((left >= least) & (right >= least), gain, -np.inf)
                best = gains.reshape(n, -1).argmax(axis=1)
                good = gains.reshape(n, -1)[np.arange(n), best] > 1e-6
                at = np.arange(n) + n - 1
                features[tree, at] = np.where(good, best // BINS, 0)
                bins[tree, at] = np.where(good, best % BINS, BINS)
                go = binned[np.arange(len(y)), features[tree, at][node]] > bins[tree, at][node]
                node = 2 * node + go
            g = np.bincount(node, gradient, 1 << depth)
            h = np.bincount(node, weight, 1 << depth)
            leaves[tree] = -rate * g / (h + ridge)
            margin += leaves[tree][node]
        return cls(edges, features, bins, leaves, constant)

    @staticmethod
    def _bin(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], axis=1).astype(np.int8)

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of yes."""
        binned = self._bin(x, self.edges)
        rows = np.arange(len(x))
        out = np.full(len(x), self.constant)
        depth = int(np.log2(self.leaves.shape[1]))
        for features, bins, leaves in zip(self.features, self.bins, self.leaves):
            node = np.zeros(len(x), dtype=np.int64)
            for level in range(depth):
                at = node + (1 << level) - 1
                node = 2 * node + (binned[rows, features[at]] > bins[at])
            out += leaves[node]
        return out
