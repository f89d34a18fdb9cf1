"""Histogram gradient-boosted trees for two classes, in numpy.

Trees are complete binary trees of one depth, flattened into arrays: node i of
a tree has children 2i+1 and 2i+2, so scoring moves all rows down a level with
one vectorised comparison.  Fitting bins each feature once at quantiles and
takes gradient histograms per node and bin.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """feature, threshold: (trees, inner nodes); leaf: (trees, leaves)."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        """P(label 1) of each row of x."""
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        inner = self.feature.shape[1]
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf):
            at = np.zeros(len(x), np.int64)
            while len(at) and at[0] < inner:
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            total += leaf[at - inner]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, n_trees: int = 60, depth: int = 4, rate: float = 0.2,
        n_bins: int = 48, ridge: float = 1.0, min_hessian: float = 1.0) -> Trees:
    """Boost on the logistic loss.  Without rows, or with one class only, the
    model is the constant log odds (with one pseudo-row of either class)."""
    inner = (1 << depth) - 1
    base = float(np.log((y.sum() + 1) / ((1 - y).sum() + 1)))
    if not len(y) or y.min() == y.max():
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), base)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, n_bins + 1)[1:-1])) for c in x.T]
    width = max(len(c) for c in cuts) + 1
    bins = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T)])
    score = np.full(len(y), base)
    feature, threshold, leaves = [], [], []
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        f_of, t_of, at = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(y), np.int64)
        for level in range(depth):
            first, count = (1 << level) - 1, 1 << level
            best = np.zeros(count)
            split = np.full(count, width)
            for k in range(len(cuts)):
                if not len(cuts[k]):
                    continue
                cell = (at - first) * width + bins[k]
                gs = np.bincount(cell, g, count * width).reshape(count, width).cumsum(1)
                hs = np.bincount(cell, h, count * width).reshape(count, width).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs ** 2 / (hs + ridge) + (gt - gs) ** 2 / (ht - hs + ridge) - gt ** 2 / (ht + ridge)
                gain[(hs < min_hessian) | (ht - hs < min_hessian)] = 0
                j = gain[:, :len(cuts[k])].argmax(1)
                won = gain[np.arange(count), j] > best + 1e-12
                best[won] = gain[np.arange(count), j][won]
                f_of[first:first + count][won] = k
                t_of[first:first + count][won] = cuts[k][j[won]]
                split[won] = j[won]
            at = 2 * at + 1 + (bins[f_of[at], np.arange(len(y))] > split[at - first])
        at -= inner
        leaf = rate * np.bincount(at, g, inner + 1) / (np.bincount(at, h, inner + 1) + ridge)
        score += leaf[at]
        feature.append(f_of), threshold.append(t_of), leaves.append(leaf)
    return Trees(np.array(feature), np.array(threshold), np.array(leaves), base)
