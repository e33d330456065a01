"""Gradient-boosted regression trees for a binary label (logistic loss), over binned features, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Tree:
    """A full binary tree: node i has children 2i+1 and 2i+2; leaves are the last level."""

    feature: np.ndarray
    limit: np.ndarray
    leaf: np.ndarray
    depth: int

    def add_to(self, x: np.ndarray, out: np.ndarray) -> None:
        at = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        for _ in range(self.depth):
            at = 2 * at + 1 + (x[rows, self.feature[at]] > self.limit[at])
        out += self.leaf[at - (2**self.depth - 1)]


class BoostedTrees:
    def __init__(self, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 32, ridge: float = 1.0):
        self.n, self.depth, self.rate, self.bins, self.ridge = trees, depth, rate, bins, ridge
        self.trees: list[Tree] = []
        self.start = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        limits = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.column_stack([np.searchsorted(limits[f], x[:, f], "left") for f in range(x.shape[1])])
        width = self.bins
        out = np.full(len(y), self.start)
        for _ in range(self.n):
            p = 1 / (1 + np.exp(-out))
            grad, hess = y - p, p * (1 - p)
            inner = 2**self.depth - 1
            feature, limit = np.zeros(inner, np.int64), np.full(inner, np.inf)
            at = np.zeros(len(y), np.int64)
            for level in range(self.depth):
                first, nodes = 2**level - 1, 2**level
                best = np.full(nodes, 1e-6)
                total_g, total_h = np.bincount(at, grad, nodes), np.bincount(at, hess, nodes)
                base = total_g**2 / (total_h + self.ridge)
                choice = np.full((nodes, 2), -1)
                for f in range(x.shape[1]):
                    if not len(limits[f]):
                        continue
                    key = at * width + binned[:, f]
                    g = np.cumsum(np.bincount(key, grad, nodes * width).reshape(nodes, width), 1)
                    h = np.cumsum(np.bincount(key, hess, nodes * width).reshape(nodes, width), 1)
                    gain = g**2 / (h + self.ridge) + (total_g[:, None] - g) ** 2 / (total_h[:, None] - h + self.ridge) - base[:, None]
                    gain = gain[:, : len(limits[f])]
                    k = gain.argmax(1)
                    better = gain[np.arange(nodes), k] > best
                    best[better] = gain[np.arange(nodes), k][better]
                    choice[better] = np.column_stack([np.full(nodes, f), k])[better]
                go = np.zeros(len(y), bool)
                for j in np.flatnonzero(choice[:, 0] >= 0):
                    f, k = choice[j]
                    feature[first + j], limit[first + j] = f, limits[f][k]
                    own = at == j
                    go[own] = x[own, f] > limits[f][k]
                at = 2 * at + go
            g, h = np.bincount(at, grad, 2**self.depth), np.bincount(at, hess, 2**self.depth)
            tree = Tree(feature, limit, self.rate * g / (h + self.ridge), self.depth)
            tree.add_to(x, out)
            self.trees.append(tree)
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for t in self.trees:
            t.add_to(x, out)
        return 1 / (1 + np.exp(-out))
