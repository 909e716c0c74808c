"""Gradient-boosted trees with monotonic constraints, flattened into node arrays.

The fit takes a bounded training matrix on the driver (the caller bounds it); scoring walks all
trees for a whole block of rows at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class NodeArrays:
    """All trees in one set of arrays. A leaf points at itself, so every row can take the same
    number of steps."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds per row: ``depth`` vector steps for all rows and trees together."""
        rows = np.arange(len(x))[:, None]
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        for _ in range(self.depth):
            below = x[rows, self.feature[at]] <= self.threshold[at]
            at = np.where(below, self.left[at], self.right[at])
        return self.base + self.value[at].sum(axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def constant(probability: float) -> NodeArrays:
    odds = float(np.log(probability / (1 - probability)))
    none = np.zeros(0, np.int32)
    return NodeArrays(none, none, np.zeros(0), none, none, np.zeros(0), 0, odds)


class _Grower:
    """One tree on binned features: at each node the split of the highest gain that keeps the
    leaf values in the order its constraint asks for."""

    def __init__(self, bins, edges, gradient, hessian, signs, depth, rate, ridge, least):
        self.bins, self.edges, self.g, self.h = bins, edges, gradient, hessian
        self.signs, self.depth, self.rate, self.ridge, self.least = signs, depth, rate, ridge, least
        self.nodes: list[list[float]] = []

    def best(self, value, low: float, high: float):
        """Clipped optimal leaf values and the loss they leave, for sums of g and h."""
        g, h = value
        w = np.clip(-g / (h + self.ridge), low, high)
        return w, g * w + 0.5 * (h + self.ridge) * w * w

    def grow(self, rows: np.ndarray, depth: int, low: float, high: float) -> int:
        here = len(self.nodes)
        total = self.g[rows].sum(), self.h[rows].sum()
        value, loss = self.best(total, low, high)
        self.nodes.append([0, 0.0, here, here, float(value) * self.rate])
        if depth == self.depth or len(rows) < 2 * self.least:
            return here
        chosen = (1e-9, -1, -1, 0.0, 0.0)
        for f, edges in enumerate(self.edges):
            if not len(edges):
                continue
            b, n = self.bins[rows, f], len(edges) + 1
            g = np.cumsum(np.bincount(b, self.g[rows], n))[:-1]
            h = np.cumsum(np.bincount(b, self.h[rows], n))[:-1]
            c = np.cumsum(np.bincount(b, minlength=n))[:-1]
            wl, ll = self.best((g, h), low, high)
            wr, lr = self.best((total[0] - g, total[1] - h), low, high)
            gain = loss - ll - lr
            gain[(c < self.least) | (len(rows) - c < self.least) | (self.signs[f] * (wr - wl) < 0)] = -np.inf
            k = int(np.argmax(gain))
            if gain[k] > chosen[0]:
                chosen = (float(gain[k]), f, k, float(wl[k]), float(wr[k]))
        _, f, k, wl, wr = chosen
        if f < 0:
            return here
        below = self.bins[rows, f] <= k
        middle = (wl + wr) / 2  # a later split below may not cross its neighbour's values
        left_high = min(high, middle) if self.signs[f] > 0 else high
        right_low = max(low, middle) if self.signs[f] > 0 else low
        left_low = max(low, middle) if self.signs[f] < 0 else low
        right_high = min(high, middle) if self.signs[f] < 0 else high
        left = self.grow(rows[below], depth + 1, left_low, left_high)
        right = self.grow(rows[~below], depth + 1, right_low, right_high)
        self.nodes[here] = [f, float(self.edges[f][k]), left, right, 0.0]
        return here


def fit(
    x: np.ndarray,
    y: np.ndarray,
    signs: list[int],
    *,
    trees: int = 40,
    depth: int = 3,
    rate: float = 0.3,
    bins: int = 64,
    ridge: float = 1.0,
    least: int = 5,
) -> NodeArrays:
    """Logistic boosting. ``signs[f]`` 1: the score may not fall as feature f grows, -1: may not
    rise, 0: free. With fewer than two classes the model is a constant."""
    if len(y) == 0 or y.min() == y.max():
        return constant(0.5 if len(y) == 0 else (len(y) * y.mean() + 0.5) / (len(y) + 1))
    cuts = np.linspace(0, 1, bins + 1)[1:-1]
    edges = []
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        middles = (values[1:] + values[:-1]) / 2
        edges.append(middles if len(middles) < bins else np.unique(np.quantile(middles, cuts)))
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    base = float(np.log(y.mean() / (1 - y.mean())))
    margin = np.full(len(y), base)
    nodes: list[list[float]] = []
    roots = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grower = _Grower(binned, edges, p - y, p * (1 - p), signs, depth, rate, ridge, least)
        grower.grow(np.arange(len(y)), 0, -np.inf, np.inf)
        start = len(nodes)
        roots.append(start)
        nodes += [[f, t, a + start, b + start, v] for f, t, a, b, v in grower.nodes]
        tree = flattened(nodes, [start], depth, 0.0)
        margin += tree.margin(x)
    return flattened(nodes, roots, depth, base)


def flattened(nodes: list[list[float]], roots: list[int], depth: int, base: float) -> NodeArrays:
    a = np.array(nodes, dtype=float)
    whole = [a[:, k].astype(np.int32) for k in (0, 2, 3)]
    return NodeArrays(np.array(roots, np.int32), whole[0], a[:, 1], whole[1], whole[2], a[:, 4], depth, base)
