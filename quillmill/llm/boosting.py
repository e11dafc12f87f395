"""Gradient-boosted trees for a yes-or-no label, on numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete trees of one depth: feature[t, i] and bound[t, i] of inner nodes, value[t, leaf]."""

    feature: np.ndarray
    bound: np.ndarray
    value: np.ndarray
    bias: float

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The probability of yes for each row."""
        z = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        depth = int(np.log2(self.value.shape[1]))
        for f, b, v in zip(self.feature, self.bound, self.value):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, f[at]] > b[at])
            z += v[at - (len(f))]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 32, least: float = 2.0, ridge: float = 1.0) -> Trees:
    """Second-order boosting over histograms of `bins` quantile bins a feature."""
    n, m = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(cuts[j], x[:, j], "left") for j in range(m)], 1)
    flat = binned + np.arange(m) * bins
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    bias = float(np.log(p / (1 - p)))
    z = np.full(n, bias)
    inner, leaves = 2**depth - 1, 2**depth
    feature, bound, value = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    for t in range(trees):
        p = 1 / (1 + np.exp(-z))
        g, h = y - p, p * (1 - p)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first, wide = 2**level - 1, 2**level
            place = ((at - first)[:, None] * (m * bins) + flat).ravel()
            hg = np.bincount(place, np.repeat(g, m), wide * m * bins).reshape(wide, m, bins).cumsum(2)
            hh = np.bincount(place, np.repeat(h, m), wide * m * bins).reshape(wide, m, bins).cumsum(2)
            gt, ht = hg[:, :, -1:], hh[:, :, -1:]
            gain = hg**2 / (hh + ridge) + (gt - hg) ** 2 / (ht - hh + ridge) - gt**2 / (ht + ridge)
            gain[(hh < least / 4) | (ht - hh < least / 4)] = -np.inf
            best = gain.reshape(wide, -1).argmax(1)
            for i in range(wide):
                j, b = divmod(int(best[i]), bins)
                if gain[i, j, b] > 1e-6 and b < len(cuts[j]):
                    feature[t, first + i], bound[t, first + i] = j, cuts[j][b]
            at = 2 * at + 1 + (x[np.arange(n), feature[t, at]] > bound[t, at])
        leaf = at - inner
        value[t] = rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + ridge)
        z += value[t, leaf]
    return Trees(feature, bound, value, bias)
