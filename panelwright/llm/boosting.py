"""Gradient-boosted decision trees for two classes, in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Tree:
    """Nodes in arrays; a leaf's feature is -1."""

    feature: list[int] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self) -> int:
        for to, x in ((self.feature, -1), (self.cut, 0.0), (self.left, -1), (self.right, -1), (self.value, 0.0)):
            to.append(x)
        return len(self.feature) - 1

    def predict(self, x: np.ndarray) -> np.ndarray:
        feature, cut, left, right, value = (np.array(a) for a in (self.feature, self.cut, self.left, self.right, self.value))
        at = np.zeros(len(x), np.int64)
        while (inner := feature[at] >= 0).any():
            rows = np.flatnonzero(inner)
            goes_left = x[rows, feature[at[rows]]] <= cut[at[rows]]
            at[rows] = np.where(goes_left, left[at[rows]], right[at[rows]])
        return value[at]


@dataclass
class Boosted:
    """Log-odds as a start value and a sum of trees; ``slope`` and ``shift`` calibrate them."""

    start: float
    trees: list[Tree]
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.start + sum((t.predict(x) for t in self.trees), np.zeros(len(x)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(x) + self.shift, -30, 30)))


def _grow(tree: Tree, x: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int, cuts: list[np.ndarray], rate: float, ridge: float) -> int:
    node = tree.add()
    total_g, total_h = g[rows].sum(), h[rows].sum()
    best = (1e-6, -1, 0.0)
    if depth and len(rows) >= 20:
        for j, edges in enumerate(cuts):
            if not len(edges):
                continue
            place = np.searchsorted(edges, x[rows, j])
            left_g = np.cumsum(np.bincount(place, g[rows], len(edges) + 1))[:-1]
            left_h = np.cumsum(np.bincount(place, h[rows], len(edges) + 1))[:-1]
            gain = left_g**2 / (left_h + ridge) + (total_g - left_g) ** 2 / (total_h - left_h + ridge) - total_g**2 / (total_h + ridge)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (float(gain[k]), j, float(edges[k]))
    if best[1] < 0:
        tree.value[node] = float(rate * total_g / (total_h + ridge))
        return node
    _, tree.feature[node], tree.cut[node] = best
    goes_left = x[rows, best[1]] <= best[2]
    tree.left[node] = _grow(tree, x, g, h, rows[goes_left], depth - 1, cuts, rate, ridge)
    tree.right[node] = _grow(tree, x, g, h, rows[~goes_left], depth - 1, cuts, rate, ridge)
    return node


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 32, ridge: float = 1.0) -> Boosted:
    """Newton boosting of the logistic loss; cuts are tried at quantiles of each feature."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[:-1])) for j in range(x.shape[1])]
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Boosted(float(np.log(share / (1 - share))), [])
    raw = np.full(len(y), model.start)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        tree = Tree()
        _grow(tree, x, y - p, np.maximum(p * (1 - p), 1e-6), np.arange(len(y)), depth, cuts, rate, ridge)
        model.trees.append(tree)
        raw += tree.predict(x)
    return model


def calibrate(model: Boosted, x: np.ndarray, y: np.ndarray, steps: int = 50) -> Boosted:
    """Platt scaling on rows that the trees weren't fitted to, by Newton's method with a weak pull to slope 1."""
    raw = model.raw(x)
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * raw + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        grad = np.array([((p - y) * raw).sum() + (a - 1), (p - y).sum() + b * 1e-3])
        hess = np.array([[(w * raw * raw).sum() + 1, (w * raw).sum()], [(w * raw).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    model.slope, model.shift = float(a), float(b)
    return model
