"""Gradient-boosted trees over histograms, kept as flat numpy node arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """All nodes of all trees. A leaf is its own child, so every row can take ``depth`` steps."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                goes_left = x[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(goes_left, self.left[node], self.right[node])
            out += self.value[node]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -40, 40)))


def _best_split(hist, directions, bounds, l2, least):
    """The best (gain, feature, bin) of one node; ``hist`` is (features, bins, 3): gradient, hessian, rows."""
    left = np.cumsum(hist, axis=1)[:, :-1]
    whole = hist[0].sum(axis=0)
    right = whole - left
    weight = lambda part: np.clip(-part[..., 0] / (part[..., 1] + l2), *bounds)

    def loss(part, w):
        return part[..., 0] * w + 0.5 * (part[..., 1] + l2) * w * w

    wl, wr, w = weight(left), weight(right), weight(whole)
    gain = loss(whole, w) - loss(left, wl) - loss(right, wr)
    ok = (left[..., 2] >= least) & (right[..., 2] >= least) & ((wr - wl) * directions[:, None] >= 0)
    gain = np.where(ok, gain, -np.inf)
    at = np.unravel_index(np.argmax(gain), gain.shape)
    return gain[at], at[0], at[1], wl[at], wr[at]


def train(
    x: np.ndarray,
    y: np.ndarray,
    directions: list[int] | None = None,
    trees: int = 60,
    depth: int = 4,
    bins: int = 64,
    rate: float = 0.2,
    l2: float = 1.0,
    least: int = 10,
) -> Forest:
    """Logistic boosting. ``directions``: per feature -1, 0 or 1, the way the score may move as it grows.

    A constrained split keeps its children's values in order, and bounds all values below
    each child by the middle of the two, so the order holds for the whole tree. Rows of one
    class alone, or none, give a constant score.
    """
    y = np.asarray(y, np.float64)
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    way = np.zeros(x.shape[1], np.int64) if directions is None else np.asarray(directions)
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T] if len(x) else []
    binned = np.column_stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, x.T, strict=False)]) if len(x) else x
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots, margin = [], np.full(len(x), base)
    two_classes = len(x) and 0 < y.sum() < len(y)
    for _ in range(trees if two_classes else 0):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        roots.append(len(nodes))
        nodes.append([0, np.inf, len(nodes), len(nodes), 0.0])
        level = [(len(nodes) - 1, np.arange(len(x)), (-np.inf, np.inf), 0)]
        while level:
            node, rows, bounds, deep = level.pop()
            value = float(np.clip(-grad[rows].sum() / (hess[rows].sum() + l2), *bounds))
            if deep < depth and len(rows) >= 2 * least:
                cells = binned[rows] + np.arange(x.shape[1]) * bins
                flat = cells.ravel()
                size = x.shape[1] * bins
                parts = [np.bincount(flat, np.repeat(v[rows], x.shape[1]), size) for v in (grad, hess)]
                hist = np.stack([*parts, np.bincount(flat, minlength=size)], axis=-1).reshape(x.shape[1], bins, 3)
                gain, f, b, wl, wr = _best_split(hist, way, bounds, l2, least)
                if gain > 1e-6 and b < len(cuts[f]):
                    middle = (wl + wr) / 2
                    low, high = bounds
                    lower = (low, middle) if way[f] > 0 else (middle, high) if way[f] < 0 else bounds
                    upper = (middle, high) if way[f] > 0 else (low, middle) if way[f] < 0 else bounds
                    goes = binned[rows, f] <= b
                    first = len(nodes)
                    nodes[node][:4] = [int(f), float(cuts[f][b]), first, first + 1]
                    nodes.append([0, np.inf, first, first, 0.0])
                    nodes.append([0, np.inf, first + 1, first + 1, 0.0])
                    level += [(first, rows[goes], lower, deep + 1), (first + 1, rows[~goes], upper, deep + 1)]
                    continue
            nodes[node][4] = rate * value
            margin[rows] += rate * value
    columns = list(zip(*nodes, strict=True)) if nodes else [[0], [np.inf], [0], [0], [0.0]]
    kinds = (np.int64, np.float64, np.int64, np.int64, np.float64)
    return Forest(*(np.array(c, k) for c, k in zip(columns, kinds, strict=True)), np.array(roots, np.int64), depth, base)
