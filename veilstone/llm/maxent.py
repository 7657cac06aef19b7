"""Binary maximum-entropy model over hashed string features, trained in numpy."""

from __future__ import annotations

import zlib

import numpy as np


class MaxEnt:
    def __init__(self, bits: int = 15):
        self.size = 1 << bits
        self.w = np.zeros(self.size)
        self.seen: dict[str, int] = {}

    def index(self, feature: str) -> int:
        i = self.seen.get(feature)
        if i is None:
            if len(self.seen) > 200_000:
                self.seen.clear()
            i = self.seen[feature] = zlib.crc32(feature.encode("utf-8", "surrogatepass")) % self.size
        return i

    def __getstate__(self):
        return {"size": self.size, "w": self.w, "seen": {}}

    def fit(self, rows: list[list[str]], y: list[int], epochs: int = 12, rate: float = 0.3, l2: float = 1e-4, seed: int = 3, weights: np.ndarray | None = None) -> "MaxEnt":
        """Adagrad over mini-batches of the regularised log-likelihood."""
        rng = np.random.default_rng(seed)
        idx = [np.array([self.index(f) for f in r]) for r in rows]
        target = np.array(y, dtype=float)
        weight = np.ones(len(y)) if weights is None else weights
        square = np.full(self.size, 1e-6)
        for _ in range(epochs):
            order = rng.permutation(len(idx))
            for i in range(0, len(order), 64):
                part = order[i : i + 64]
                flat = np.concatenate([idx[k] for k in part])
                row = np.repeat(np.arange(len(part)), [len(idx[k]) for k in part])
                z = np.bincount(row, weights=self.w[flat], minlength=len(part))
                err = (target[part] - 1 / (1 + np.exp(-z))) * weight[part]
                use, at = np.unique(flat, return_inverse=True)
                grad = np.bincount(at, weights=err[row]) - l2 * len(part) * self.w[use]
                square[use] += grad**2
                self.w[use] += rate * grad / np.sqrt(square[use])
        return self

    def score(self, features: list[str]) -> float:
        w, index = self.w, self.index
        return float(sum(w[index(f)] for f in features))
