"""Gradient-boosted trees for small, bounded training sets."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Tree:
    """A complete tree: split feature and bin of each inner node, value of each leaf."""

    feature: np.ndarray
    edge: np.ndarray
    value: np.ndarray

    def leaves(self, binned: np.ndarray) -> np.ndarray:
        at = np.zeros(len(binned), dtype=np.int64)
        rows = np.arange(len(binned))
        while len(self.feature) and at.max(initial=0) < len(self.feature):
            at = 2 * at + 1 + (binned[rows, self.feature[at]] > self.edge[at])
        return at - len(self.feature)


@dataclass
class Boosted:
    edges: list[np.ndarray]
    trees: list[Tree]
    start: float
    rate: float

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(self.edges)], axis=1) if len(x) else np.zeros((0, len(self.edges)), dtype=np.int64)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        b, total = self.binned(x), np.full(len(x), self.start)
        for tree in self.trees:
            total += self.rate * tree.value[tree.leaves(b)]
        return 1 / (1 + np.exp(-total))


def grow(binned: np.ndarray, bins: int, gradient: np.ndarray, hessian: np.ndarray, depth: int, penalty: float, least: float) -> Tree:
    """Level by level, the split of every node with the largest gain of the second-order loss."""
    inner = (1 << depth) - 1
    feature, edge = np.zeros(inner, dtype=np.int64), np.full(inner, bins, dtype=np.int64)
    node = np.zeros(len(binned), dtype=np.int64)
    for level in range(depth):
        first, wide = (1 << level) - 1, 1 << level
        place = node - first
        gain_of = lambda g, h: g * g / (h + penalty)
        best = np.full(wide, 1e-9)
        for k in range(binned.shape[1]):
            cell = place * bins + binned[:, k]
            g = np.bincount(cell, gradient, wide * bins).reshape(wide, bins).cumsum(axis=1)
            h = np.bincount(cell, hessian, wide * bins).reshape(wide, bins).cumsum(axis=1)
            gain = gain_of(g, h) + gain_of(g[:, -1:] - g, h[:, -1:] - h) - gain_of(g[:, -1:], h[:, -1:])
            gain[(h < least) | (h[:, -1:] - h < least)] = 0
            top = gain.argmax(axis=1)
            value = gain[np.arange(wide), top]
            better = value > best
            best[better] = value[better]
            feature[first : first + wide][better] = k
            edge[first : first + wide][better] = top[better]
        node = 2 * node + 1 + (binned[np.arange(len(binned)), feature[node]] > edge[node])
    leaf = node - inner
    g, h = np.bincount(leaf, gradient, inner + 1), np.bincount(leaf, hessian, inner + 1)
    return Tree(feature, edge, -g / (h + penalty))


def boost(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 16, penalty: float = 1.0, least: float = 1.0) -> Boosted:
    """Logistic loss; ``y`` holds 0 and 1."""
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for k in range(x.shape[1])]
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Boosted(edges, [], float(np.log(share / (1 - share))), rate)
    binned, total = model.binned(x), np.full(len(x), model.start)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        tree = grow(binned, bins, p - y, p * (1 - p), depth, penalty, least)
        model.trees.append(tree)
        total += rate * tree.value[tree.leaves(binned)]
    return model
