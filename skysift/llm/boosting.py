"""Gradient-boosted trees for small tables: log loss, quantile bins, fixed depth."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class BoostedTrees:
    """Complete binary trees: feature and cut of each inner node, value of each leaf."""

    depth: int = 3
    rounds: int = 40
    rate: float = 0.2
    ridge: float = 1.0
    start: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray, bins: int = 32) -> BoostedTrees:
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
        mean = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.start, self.trees = float(np.log(mean / (1 - mean))), []
        score = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            self.trees.append(tree := self._tree(x, p - y, p * (1 - p) + 1e-9, cuts))
            score = score + self._leaf(tree, x)
        return self

    def _tree(self, x: np.ndarray, g: np.ndarray, h: np.ndarray, cuts: list[np.ndarray]):
        inner = 2**self.depth - 1
        feature, cut, value = np.zeros(inner, int), np.full(inner, np.inf), np.zeros(inner + 1)
        inside = np.zeros(len(x), int)
        for node in range(inner):
            rows = np.flatnonzero(inside == node)
            gain, best = 1e-9, None
            if len(rows) > 1:
                gs, hs = g[rows].sum(), h[rows].sum()
                for f, levels in enumerate(cuts):
                    if not len(levels):
                        continue
                    at = np.searchsorted(levels, x[rows, f])  # rows with x <= levels[k] have at <= k
                    gl = np.cumsum(np.bincount(at, g[rows], len(levels) + 1))[:-1]
                    hl = np.cumsum(np.bincount(at, h[rows], len(levels) + 1))[:-1]
                    won = gl**2 / (hl + self.ridge) + (gs - gl) ** 2 / (hs - hl + self.ridge) - gs**2 / (hs + self.ridge)
                    if won.max() > gain:
                        gain, best = won.max(), (f, levels[int(won.argmax())])
            if best:
                feature[node], cut[node] = best
            inside[rows] = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
        for leaf in range(inner + 1):
            rows = inside == inner + leaf
            value[leaf] = -self.rate * g[rows].sum() / (h[rows].sum() + self.ridge)
        return feature, cut, value

    def _leaf(self, tree, x: np.ndarray) -> np.ndarray:
        feature, cut, value = tree
        at = np.zeros(len(x), int)
        rows = np.arange(len(x))
        for _ in range(self.depth):
            at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
        return value[at - len(feature)]

    def predict(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.start)
        for tree in self.trees:
            score = score + self._leaf(tree, x)
        return 1 / (1 + np.exp(-score))


def calibrated_cut(scores: np.ndarray, labels: np.ndarray, precision: float) -> float:
    """The least score from which on held-out rows have the precision; above 1 where none has."""
    order = np.argsort(-scores, kind="stable")
    right = np.cumsum(labels[order]) / np.arange(1, len(order) + 1)
    s = scores[order]
    last = np.append(s[1:] != s[:-1], True)  # a cut can't part equal scores
    good = np.flatnonzero((right >= precision) & last)
    return float(s[good[-1]]) if len(good) else 1.01
