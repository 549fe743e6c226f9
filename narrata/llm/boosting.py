"""Gradient-boosted regression trees for a yes-no label: level-wise growth on binned features, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

TREES, DEPTH, RATE, BINS, RIDGE = 60, 4, 0.2, 32, 1.0


@dataclass
class Model:
    edges: list[np.ndarray]
    feature: np.ndarray  # (tree, inner node)
    bound: np.ndarray  # bin above which a row goes right
    leaf: np.ndarray
    start: float

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], "left") for k, e in enumerate(self.edges)], 1).astype(np.uint8)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of yes."""
        b, rows, out = self.binned(x), np.arange(len(x)), np.full(len(x), self.start)
        for feature, bound, leaf in zip(self.feature, self.bound, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (b[rows, feature[node]] > bound[node])
            out += leaf[node - (2**DEPTH - 1)]
        return out


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, trees: int = TREES) -> Model:
    weight = np.ones(len(x)) if weight is None else weight
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]
    share = np.clip((weight * y).sum() / weight.sum(), 0.01, 0.99)
    inner = 2**DEPTH - 1
    model = Model(edges, np.zeros((trees, inner), np.int64), np.full((trees, inner), 255), np.zeros((trees, inner + 1)), float(np.log(share / (1 - share))))
    b = model.binned(x)
    columns, f = x.shape[1], np.full(len(x), model.start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-f))
        g, h = weight * (y - p), weight * np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(x), np.int64)
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            local = node - first
            best = np.zeros(width)
            for k in range(columns):
                cell = local * BINS + b[:, k]
                gs = np.cumsum(np.bincount(cell, g, width * BINS).reshape(width, BINS), 1)
                hs = np.cumsum(np.bincount(cell, h, width * BINS).reshape(width, BINS), 1)
                gl, hl, ga, ha = gs[:, :-1], hs[:, :-1], gs[:, -1:], hs[:, -1:]
                gain = gl**2 / (hl + RIDGE) + (ga - gl) ** 2 / (ha - hl + RIDGE) - ga**2 / (ha + RIDGE)
                spot = gain.argmax(1)
                top = gain[np.arange(width), spot]
                better = top > best + 1e-9
                best[better] = top[better]
                model.feature[t, first + np.flatnonzero(better)] = k
                model.bound[t, first + np.flatnonzero(better)] = spot[better]
            node = 2 * node + 1 + (b[np.arange(len(x)), model.feature[t, node]] > model.bound[t, node])
        leaf = node - inner
        model.leaf[t] = RATE * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + RIDGE)
        f += model.leaf[t, leaf]
    return model
