"""Gradient-boosted regression trees for a yes/no target, in numpy: histogram splits, logistic loss."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Trees are arrays of (feature, threshold, left, right, value); predict walks all rows level by level."""

    def __init__(self, trees: int = 50, depth: int = 4, rate: float = 0.3, bins: int = 32, least: float = 1.0, l2: float = 1.0):
        self.n_trees, self.depth, self.rate, self.bins, self.least, self.l2 = trees, depth, rate, bins, least, l2
        self.trees: list[tuple[np.ndarray, ...]] = []
        self.base = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> "BoostedTrees":
        n, width = x.shape
        self.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins + 1)[1:-1], method="lower")) for f in range(width)]
        code = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(self.edges)], axis=1)
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        score = np.full(n, self.base)
        for _ in range(self.n_trees):
            p = 1 / (1 + np.exp(-score))
            tree = self._grow(code, y - p, p * (1 - p))
            self.trees.append(tree)
            score += self._walk(tree, x)
        return self

    def _grow(self, code: np.ndarray, grad: np.ndarray, hess: np.ndarray) -> tuple[np.ndarray, ...]:
        width, most = code.shape[1], max(map(len, self.edges)) + 1
        base = np.arange(width) * most
        cuts = np.arange(most)[None, :] < np.array(list(map(len, self.edges)))[:, None]
        feature, cut, left, right, value = [-1], [0.0], [-1], [-1], [0.0]
        work = [(0, np.arange(len(grad)), 0)]
        while work:
            node, rows, level = work.pop()
            g, h = grad[rows].sum(), hess[rows].sum()
            value[node] = self.rate * g / (h + self.l2)
            if level == self.depth or h < 2 * self.least:
                continue
            # histograms of all features at once; a split after bin k of feature f
            flat = (code[rows] + base).ravel()
            gl, hl = (np.cumsum(np.bincount(flat, weights=np.repeat(v[rows], width), minlength=width * most).reshape(width, most), axis=1) for v in (grad, hess))
            ok = cuts & (hl >= self.least) & (h - hl >= self.least)
            gain = np.where(ok, gl**2 / (hl + self.l2) + (g - gl) ** 2 / np.maximum(h - hl + self.l2, 1e-12) - g**2 / (h + self.l2), 0)
            f, k = divmod(int(gain.argmax()), most)
            if gain[f, k] <= 1e-6:
                continue
            feature[node], cut[node] = f, float(self.edges[f][k])
            goes = code[rows, f] <= k
            for side, part in ((left, rows[goes]), (right, rows[~goes])):
                side[node] = len(feature)
                feature.append(-1), cut.append(0.0), left.append(-1), right.append(-1), value.append(0.0)
                work.append((side[node], part, level + 1))
        return tuple(map(np.array, (feature, cut, left, right, value)))

    def _walk(self, tree: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
        feature, cut, left, right, value = tree
        at = np.zeros(len(x), dtype=np.int64)
        rows = np.arange(len(x))
        for _ in range(self.depth):
            f = feature[at]
            inner = f >= 0
            if not inner.any():
                break
            goes = x[rows, np.maximum(f, 0)] <= cut[at]
            at = np.where(inner, np.where(goes, left[at], right[at]), at)
        return value[at]

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of yes."""
        score = np.full(len(x), self.base)
        for tree in self.trees:
            score += self._walk(tree, x)
        return 1 / (1 + np.exp(-score))
