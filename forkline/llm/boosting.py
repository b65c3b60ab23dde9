"""Gradient-boosted trees for two classes, in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class BoostedTrees:
    """Depth-limited trees fitted to the logistic loss with second-order leaf values."""

    trees: int = 40
    depth: int = 3
    rate: float = 0.3
    l2: float = 1.0
    base: float = 0.0
    #: Per tree: feature and threshold of the inner nodes in level order, then the leaves' values.
    nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(p / (1 - p)))
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 33)[1:-1])) for j in range(x.shape[1])]
        below = [x[:, j, None] <= c for j, c in enumerate(cuts)]
        score = np.full(len(y), self.base)
        for _ in range(self.trees):
            prob = sigmoid(score)
            g, h = prob - y, prob * (1 - prob) + 1e-9
            inner = 2**self.depth - 1
            feat, cut = np.zeros(inner, int), np.full(inner, np.inf)
            node = np.zeros(len(y), int)
            for i in range(inner):
                own = node == i
                best = 1e-9
                if own.any():
                    gs, hs = g[own].sum(), h[own].sum()
                    for j, b in enumerate(below):
                        if not b.shape[1]:
                            continue
                        gl, hl = g[own] @ b[own], h[own] @ b[own]
                        gain = gl**2 / (hl + self.l2) + (gs - gl) ** 2 / (hs - hl + self.l2) - gs**2 / (hs + self.l2)
                        k = int(gain.argmax())
                        if gain[k] > best:
                            best, feat[i], cut[i] = gain[k], j, cuts[j][k]
                node[own] = 2 * i + 1 + (x[own, feat[i]] > cut[i])
            leaf = node - inner
            values = np.array([-(g[leaf == k].sum()) / (h[leaf == k].sum() + self.l2) for k in range(inner + 1)]) * self.rate
            self.nodes.append((feat, cut, values))
            score += values[leaf]
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feat, cut, values in self.nodes:
            node = np.zeros(len(x), int)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feat[node]] > cut[node])
            out += values[node - len(feat)]
        return out


def platt(margin: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and intercept that calibrate margins to probabilities, by Newton steps."""
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = sigmoid(a * margin + b)
        w = p * (1 - p) + 1e-6
        grad = np.array([((p - y) * margin).sum() + 1e-3 * (a - 1), (p - y).sum()])
        hess = np.array([[(w * margin * margin).sum() + 1e-3, (w * margin).sum()], [(w * margin).sum(), w.sum() + 1e-9]])
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-6:
            break
    return float(a), float(b)
