"""Small gradient-boosted trees for bounded training samples (logistic loss, histogram splits)."""

from __future__ import annotations

import numpy as np


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Boosted:
    """Trees over binned features; ``raw`` gives log-odds."""

    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 16, least: float = 5.0):
        self.rounds, self.depth, self.rate, self.bins, self.least = rounds, depth, rate, bins, least

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], "right") for f, e in enumerate(self.edges)], 1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins + 1)[1:-1])) for f in range(x.shape[1])]
        # a cut lies between two values, so that a value met in training has one side
        b = self._bin(x)
        p0 = np.clip(y.mean(), 1e-3, 1 - 1e-3) if len(y) else 0.5
        self.start = float(np.log(p0 / (1 - p0)))
        self.trees: list[list] = []
        z = np.full(len(y), self.start)
        for _ in range(self.rounds if len(y) else 0):
            p = sigmoid(z)
            grad, hess = y - p, np.maximum(p * (1 - p), 1e-6)
            tree, step = self._grow(b, grad, hess, np.arange(len(y)), 0)
            self.trees.append(tree)
            z += self.rate * self._walk(tree, b)
            if step == 0:
                break
        return self

    def _grow(self, b, g, h, rows, depth):
        total_g, total_h = g[rows].sum(), h[rows].sum()
        leaf = total_g / (total_h + 1.0)
        if depth == self.depth or len(rows) < 2 * self.least:
            return [leaf], 0
        best, at = 1e-3, None
        for f in range(b.shape[1]):
            n = len(self.edges[f]) + 1
            if n < 2:
                continue
            gs = np.cumsum(np.bincount(b[rows, f], g[rows], n))[:-1]
            hs = np.cumsum(np.bincount(b[rows, f], h[rows], n))[:-1]
            cs = np.cumsum(np.bincount(b[rows, f], minlength=n))[:-1]
            gain = gs ** 2 / (hs + 1) + (total_g - gs) ** 2 / (total_h - hs + 1) - total_g ** 2 / (total_h + 1)
            gain[(cs < self.least) | (len(rows) - cs < self.least)] = -1
            k = int(np.argmax(gain))
            if gain[k] > best:
                best, at = gain[k], (f, k)
        if at is None:
            return [leaf], 0
        left = b[rows, at[0]] <= at[1]
        return [at[0], at[1], self._grow(b, g, h, rows[left], depth + 1)[0],
                self._grow(b, g, h, rows[~left], depth + 1)[0]], best

    def _walk(self, tree, b):
        if len(tree) == 1:
            return np.full(len(b), tree[0])
        left = b[:, tree[0]] <= tree[1]
        out = np.empty(len(b))
        out[left] = self._walk(tree[2], b[left])
        out[~left] = self._walk(tree[3], b[~left])
        return out

    def raw(self, x: np.ndarray) -> np.ndarray:
        b = self._bin(x)
        z = np.full(len(x), self.start)
        for t in self.trees:
            z += self.rate * self._walk(t, b)
        return z
