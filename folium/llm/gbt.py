"""Gradient-boosted trees on small dense matrices: histogram splits, logistic loss, Platt calibration.

Models are fitted on the driver (of all rows of a frame by fitting.py) and applied by numpy to
whole Arrow batches; a model is a few hundred numbers.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Tree:
    feature: list[int] = field(default_factory=list)  # -1: leaf
    cut: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self) -> int:
        for x, v in ((self.feature, -1), (self.cut, 0.0), (self.left, 0), (self.right, 0), (self.value, 0.0)):
            x.append(v)
        return len(self.feature) - 1

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        f, c, l, r, v = (np.asarray(a) for a in (self.feature, self.cut, self.left, self.right, self.value))
        while True:
            live = np.flatnonzero(f[at] >= 0)
            if not len(live):
                return v[at]
            node = at[live]
            at[live] = np.where(x[live, f[node]] <= c[node], l[node], r[node])


@dataclass
class Boosted:
    trees: list[Tree]
    base: float
    rate: float
    a: float = 1.0  # calibration: sigmoid(a * score + b)
    b: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        s = np.full(len(x), self.base)
        for t in self.trees:
            s += self.rate * t.predict(x)
        return s

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.a * self.score(x) + self.b)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.25, bins: int = 32, least: float = 4.0, ridge: float = 1.0) -> Boosted:
    """Boost trees of the given depth on features x and labels y in {0, 1}. One class only gives a constant model."""
    x, y = np.asarray(x, float), np.asarray(y, float)
    p = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    model = Boosted([], float(np.log(p / (1 - p))), rate)
    if len(np.unique(y)) < 2:
        return model
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    code = np.column_stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)])
    score = np.full(len(y), model.base)
    for _ in range(rounds):
        pr = sigmoid(score)
        g, h = y - pr, np.maximum(pr * (1 - pr), 1e-6)
        tree = Tree()
        stack = [(tree.add(), np.arange(len(y)), 0)]
        while stack:
            node, rows, level = stack.pop()
            gs, hs = g[rows].sum(), h[rows].sum()
            tree.value[node] = gs / (hs + ridge)
            if level == depth or len(rows) < 2 * least:
                continue
            best = (1e-6, -1, 0)
            for j, c in enumerate(cuts):
                if not len(c):
                    continue
                k = code[rows, j]
                gl = np.cumsum(np.bincount(k, g[rows], len(c) + 1))[:-1]
                hl = np.cumsum(np.bincount(k, h[rows], len(c) + 1))[:-1]
                nl = np.cumsum(np.bincount(k, minlength=len(c) + 1))[:-1]
                gain = gl**2 / (hl + ridge) + (gs - gl) ** 2 / (hs - hl + ridge) - gs**2 / (hs + ridge)
                gain[(nl < least) | (len(rows) - nl < least)] = 0
                i = int(gain.argmax())
                if gain[i] > best[0]:
                    best = (gain[i], j, i)
            if best[1] < 0:
                continue
            _, j, i = best
            m = code[rows, j] <= i
            tree.feature[node], tree.cut[node] = j, float(cuts[j][i])
            tree.left[node], tree.right[node] = tree.add(), tree.add()
            stack += [(tree.left[node], rows[m], level + 1), (tree.right[node], rows[~m], level + 1)]
        model.trees.append(tree)
        score = score + rate * tree.predict(x)
    return model


def calibrate(model: Boosted, x: np.ndarray, y: np.ndarray, steps: int = 200) -> Boosted:
    """Platt scaling on a holdout: fits a and b of sigmoid(a * score + b), drawn to (1, 0) as the holdout is small."""
    s, y = model.score(np.asarray(x, float)), np.asarray(y, float)
    a, b = 1.0, 0.0
    for _ in range(steps):
        e = sigmoid(a * s + b) - y
        a -= 0.05 * ((e * s).mean() + 0.01 * (a - 1))
        b -= 0.05 * (e.mean() + 0.01 * b)
    model.a, model.b = float(max(a, 0.05)), float(b)
    return model
