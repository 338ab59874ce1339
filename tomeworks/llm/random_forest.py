"""A small random forest for binary labels: Gini splits over quantile bins, bootstrap samples, flat arrays for prediction."""

from __future__ import annotations

import numpy as np


class RandomForest:
    def __init__(self, trees: int = 40, depth: int = 9, least: int = 3, bins: int = 24, seed: int = 7):
        self.trees, self.depth, self.least, self.bins, self.seed = trees, depth, least, bins, seed

    def fit(self, x: np.ndarray, y: np.ndarray) -> RandomForest:
        rng = np.random.default_rng(self.seed)
        n, d = x.shape
        self.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins + 1)[1:-1])) for f in range(d)]
        binned = np.stack([np.searchsorted(self.edges[f], x[:, f], "left") for f in range(d)], axis=1)
        self.nodes = [self._grow(binned, y, rng.integers(0, n, n), rng, max(1, round(d**0.5))) for _ in range(self.trees)]
        return self

    def _grow(self, x: np.ndarray, y: np.ndarray, rows: np.ndarray, rng: np.random.Generator, tries: int) -> tuple[np.ndarray, ...]:
        feature, bar, left, right, value = [], [], [], [], []

        def grow(rows: np.ndarray, depth: int) -> int:
            me = len(feature)
            for a, v in ((feature, -1), (bar, 0), (left, 0), (right, 0), (value, float(y[rows].mean()))):
                a.append(v)
            if depth == self.depth or len(rows) < 2 * self.least or value[me] in (0.0, 1.0):
                return me
            best = (1e-12, -1, 0)
            total, ones = len(rows), y[rows].sum()
            base = 2 * (ones / total) * (1 - ones / total)
            for f in rng.permutation(x.shape[1])[:tries]:
                n = np.bincount(x[rows, f], minlength=self.bins + 1).cumsum()[:-1]
                k = np.bincount(x[rows, f], y[rows], minlength=self.bins + 1).cumsum()[:-1]
                m, j = total - n, ones - k
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = base - (2 * k * (1 - k / n) + 2 * j * (1 - j / m)) / total
                gain = np.where((n >= self.least) & (m >= self.least), gain, -1)
                b = int(gain.argmax())
                if gain[b] > best[0]:
                    best = (float(gain[b]), int(f), b)
            if best[1] >= 0:
                low = x[rows, best[1]] <= best[2]
                feature[me], bar[me] = best[1], best[2]
                left[me], right[me] = grow(rows[low], depth + 1), grow(rows[~low], depth + 1)
            return me

        grow(rows, 0)
        return tuple(np.array(a) for a in (feature, bar, left, right, value))

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The share of positives, averaged over the trees."""
        if not len(x):
            return np.zeros(0)
        binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(self.edges)], axis=1)
        rows, total = np.arange(len(x)), np.zeros(len(x))
        for feature, bar, left, right, value in self.nodes:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = feature[at]
                go = np.where(binned[rows, np.maximum(f, 0)] <= bar[at], left[at], right[at])
                at = np.where(f >= 0, go, at)
            total += value[at]
        return total / len(self.nodes)
