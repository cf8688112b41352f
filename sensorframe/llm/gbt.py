"""Histogram gradient-boosted trees for two classes, kept as flat arrays, and isotonic calibration."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Trees of one depth as arrays over (tree, node): a node's children are 2 n + 1 and 2 n + 2."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Sum of the leaves' values for every row: all rows go down all trees a level at a time."""
        depth = int(np.log2(self.feature.shape[1] + 1))
        tree = np.arange(len(self.feature))[None, :]
        row = np.arange(len(x))[:, None]
        node = np.zeros((len(x), len(self.feature)), dtype=np.int64)
        for _ in range(depth):
            node = 2 * node + 1 + (x[row, self.feature[tree, node]] > self.threshold[tree, node])
        return self.start + self.value[tree, node].sum(axis=1)

    def score(self, x: np.ndarray, rows: int = 4096) -> np.ndarray:
        """Probability of class 1."""
        parts = [self.margin(x[i : i + rows]) for i in range(0, len(x), rows)]
        return 1 / (1 + np.exp(-np.concatenate(parts))) if parts else np.zeros(0)


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 1.0, least: float = 5.0) -> Trees:
    """Boost regression trees on the logistic loss over binned features.

    A level of a tree takes one histogram of gradients a feature; a node without a split
    that gains sends all rows to its left. Without rows, or of one class, the trees give the smoothed share of class 1.
    """
    n, m = x.shape
    rate0 = (y.sum() + 0.5) / (n + 1)
    start = float(np.log(rate0 / (1 - rate0)))
    inner, leaves = (1 << depth) - 1, 1 << depth
    feature = np.zeros((trees, inner), dtype=np.int64)
    threshold = np.full((trees, inner), np.inf)
    value = np.zeros((trees, inner + leaves))
    if n == 0 or y.min() == y.max():
        return Trees(feature[:0], threshold[:0], value[:0], start)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(m)]
    code = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    margin = np.full(n, start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)  # within its level
        for level in range(depth):
            nodes = 1 << level
            total_g, total_h = np.bincount(node, g, nodes), np.bincount(node, h, nodes)
            best = np.full(nodes, 1e-6)
            f_of, b_of = np.zeros(nodes, dtype=np.int64), np.full(nodes, -1)
            for f in range(m):
                if not len(cuts[f]):
                    continue
                key = node * bins + code[:, f]
                gl = np.bincount(key, g, nodes * bins).reshape(nodes, bins).cumsum(axis=1)[:, : len(cuts[f])]
                hl = np.bincount(key, h, nodes * bins).reshape(nodes, bins).cumsum(axis=1)[:, : len(cuts[f])]
                gr, hr = total_g[:, None] - gl, total_h[:, None] - hl
                gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - (total_g**2 / (total_h + ridge))[:, None]
                gain[(hl < least / 4) | (hr < least / 4)] = 0
                at = gain.argmax(axis=1)
                better = gain[np.arange(nodes), at] > best
                best = np.where(better, gain[np.arange(nodes), at], best)
                f_of, b_of = np.where(better, f, f_of), np.where(better, at, b_of)
            first = nodes - 1
            feature[t, first : first + nodes] = f_of
            threshold[t, first : first + nodes] = [cuts[f][b] if b >= 0 else np.inf for f, b in zip(f_of, b_of, strict=True)]
            split = b_of[node]
            node = 2 * node + ((code[np.arange(n), f_of[node]] > split) & (split >= 0))
        total_g, total_h = np.bincount(node, g, leaves), np.bincount(node, h, leaves)
        leaf = -rate * total_g / (total_h + ridge)
        value[t, inner:] = leaf
        margin += leaf[node]
    return Trees(feature, threshold, value, start)


@dataclass
class Isotonic:
    """A rising step function, with straight lines between its steps."""

    x: np.ndarray
    y: np.ndarray

    def __call__(self, score: np.ndarray) -> np.ndarray:
        return np.interp(score, self.x, self.y) if len(self.x) else score


def isotonic(score: np.ndarray, label: np.ndarray) -> Isotonic:
    """Pool adjacent violators over rows in order of their score; equal scores are one block from the start.

    Each block counts half a row of either class more, so that no score becomes quite 0 or 1.
    """
    x, inverse = np.unique(score, return_inverse=True)
    blocks: list[list[float]] = []  # sum of labels, rows, first and last score
    for v, s, n in zip(x, np.bincount(inverse, label), np.bincount(inverse), strict=True):
        blocks.append([s, n, v, v])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, n, _, last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + n, blocks[-1][2], last]
    xs = [v for b in blocks for v in (b[2], b[3])]
    ys = [(b[0] + 0.5) / (b[1] + 1) for b in blocks for _ in (0, 1)]
    return Isotonic(np.array(xs), np.maximum.accumulate(np.array(ys)) if ys else np.array(ys))
