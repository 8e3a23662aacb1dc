"""Gradient-boosted trees for two classes on binned features, and isotonic calibration: small models, fitted on bounded samples."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Trees:
    """Trees of equal depth; ``fit`` needs labels of 0 and 1. With one class only, the score is a constant."""

    rounds: int = 80
    depth: int = 3
    rate: float = 0.15
    bins: int = 48
    ridge: float = 2.0
    least: int = 10
    base: float = 0.0
    nodes: list = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.nodes = []
        share = (y.sum() + 0.5) / (len(y) + 1)
        self.base = float(np.log(share / (1 - share)))
        if not len(y) or y.min() == y.max():
            return self
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)])
        score = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            grad, hess = p - y, p * (1 - p)
            node = np.zeros(len(y), int)
            feature, cut = np.zeros(2**self.depth - 1, int), np.full(2**self.depth - 1, np.inf)
            for level in range(self.depth):
                for n in range(2**level - 1, 2 ** (level + 1) - 1):
                    own = np.flatnonzero(node == n)
                    found = self._split(binned[:, own], grad[own], hess[own]) if len(own) >= 2 * self.least else None
                    if found:
                        feature[n], cut[n] = found[0], cuts[found[0]][found[1]]
                right = x[np.arange(len(y)), feature[node]] > cut[node]
                node = 2 * node + 1 + right
            leaf = node - (2**self.depth - 1)
            total, weight = np.bincount(leaf, grad, 2**self.depth), np.bincount(leaf, hess, 2**self.depth)
            value = -self.rate * total / (weight + self.ridge)
            score += value[leaf]
            self.nodes.append((feature, cut, value))
        return self

    def _split(self, binned, grad, hess):
        best, where = 1e-6, None
        whole_g, whole_h = grad.sum(), hess.sum()
        for f, column in enumerate(binned):
            g, h, n = (np.cumsum(np.bincount(column, w, self.bins))[:-1] for w in (grad, hess, None))
            gain = g**2 / (h + self.ridge) + (whole_g - g) ** 2 / (whole_h - h + self.ridge) - whole_g**2 / (whole_h + self.ridge)
            gain[(n < self.least) | (len(column) - n < self.least)] = 0
            at = int(gain.argmax())
            if gain[at] > best:
                best, where = gain[at], (f, at)
        return where

    def logit(self, x: np.ndarray) -> np.ndarray:
        score, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, value in self.nodes:
            node = np.zeros(len(x), int)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            score += value[node - (2**self.depth - 1)]
        return score


@dataclass
class Isotonic:
    """A non-decreasing step curve from scores to probabilities, straight between steps, by pooling adjacent violators."""

    at: np.ndarray = field(default_factory=lambda: np.zeros(1))
    to: np.ndarray = field(default_factory=lambda: np.full(1, 0.5))

    def fit(self, score: np.ndarray, y: np.ndarray) -> Isotonic:
        if not len(y):
            return self
        where, inverse = np.unique(score, return_inverse=True)
        blocks: list[list[float]] = []
        for s, total, n in zip(where, np.bincount(inverse, y), np.bincount(inverse), strict=True):
            blocks.append([total, n, s, s])
            while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
                total, n, _, last = blocks.pop()
                blocks[-1][0] += total
                blocks[-1][1] += n
                blocks[-1][3] = last
        # Half a row on either side keeps ends short of certainty.
        self.at = np.array([s for b in blocks for s in b[2:]])
        self.to = np.repeat([(b[0] + 0.5 * y.mean()) / (b[1] + 0.5) for b in blocks], 2)
        self.to = np.maximum.accumulate(self.to)
        return self

    def __call__(self, score: np.ndarray) -> np.ndarray:
        return np.interp(score, self.at, self.to)


def calibrated(x: np.ndarray, y: np.ndarray, folds: int = 4) -> tuple[Trees, Isotonic]:
    """Trees on all rows, and a curve fitted to scores of trees that hadn't seen the rows."""
    held = np.zeros(len(y))
    for k in range(folds):
        out = np.arange(len(y)) % folds == k
        if out.any() and (~out).any():
            held[out] = Trees().fit(x[~out], y[~out]).logit(x[out])
    return Trees().fit(x, y), Isotonic().fit(held, y)
