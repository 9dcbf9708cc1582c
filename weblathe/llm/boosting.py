"""Gradient-boosted trees for two-class problems: a small histogram trainer, numpy scoring and a SQL form.

Training runs on the driver over a bounded sample; scoring is a sum over trees, in numpy (``Trees.score``) or as a SQL
expression (``Trees.sql``), both over the same thresholds.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

#: A node is (feature, threshold, left, right), taken left where value <= threshold; a leaf is a float.
Node = tuple | float


@dataclass
class Trees:
    names: list[str]
    start: float = 0.0
    roots: list[Node] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row."""
        total = np.full(len(x), self.start)
        for root in self.roots:
            stack = [(root, np.arange(len(x)))]
            while stack:
                node, rows = stack.pop()
                if not isinstance(node, tuple):
                    total[rows] += node
                elif len(rows):
                    left = x[rows, node[0]] <= node[1]
                    stack += [(node[2], rows[left]), (node[3], rows[~left])]
        return total

    def sql(self, prefix: str) -> str:
        """The same sum as SQL over the columns or fields ``prefix`` + name."""

        def of(node: Node) -> str:
            if not isinstance(node, tuple):
                return f"{node!r}D"
            return f"IF({prefix}{self.names[node[0]]} <= {node[1]!r}D, {of(node[2])}, {of(node[3])})"

        return " + ".join([f"{self.start!r}D", *map(of, self.roots)])


def fit(x: np.ndarray, y: np.ndarray, names: list[str], trees: int = 40, depth: int = 3, rate: float = 0.2, least: float = 5.0, weight: np.ndarray | None = None) -> Trees:
    """Fit by logistic loss with second-order leaves. ``least``: the smallest hessian-weighted rows of a leaf, times 4."""
    x, y = np.asarray(x, float), np.asarray(y, float)
    w = np.ones(len(y)) if weight is None else np.asarray(weight, float)
    cuts = []
    for k in range(x.shape[1]):
        values = np.unique(x[:, k])
        if len(values) > 33:
            values = np.unique(np.quantile(x[:, k], np.linspace(0, 1, 33)))
        cuts.append((values[:-1] + values[1:]) / 2)
    binned = np.stack([np.searchsorted(c, x[:, k], "left") for k, c in enumerate(cuts)], axis=1)
    share = np.clip((w @ y) / w.sum(), 0.01, 0.99)
    model = Trees(list(names), float(np.log(share / (1 - share))))
    total = np.full(len(y), model.start)

    def grow(rows: np.ndarray, level: int, g: np.ndarray, h: np.ndarray) -> Node:
        sum_g, sum_h = g[rows].sum(), h[rows].sum()
        leaf = float(rate * sum_g / (sum_h + 1.0))
        if level == 0:
            return leaf
        best = (1e-3, None)
        for k, c in enumerate(cuts):
            if not len(c):
                continue
            left_g = np.cumsum(np.bincount(binned[rows, k], g[rows], len(c) + 1))[:-1]
            left_h = np.cumsum(np.bincount(binned[rows, k], h[rows], len(c) + 1))[:-1]
            gain = left_g**2 / (left_h + 1) + (sum_g - left_g) ** 2 / (sum_h - left_h + 1) - sum_g**2 / (sum_h + 1)
            gain[(left_h < least / 4) | (sum_h - left_h < least / 4)] = 0
            at = int(np.argmax(gain))
            if gain[at] > best[0]:
                best = (float(gain[at]), (k, at))
        if best[1] is None:
            return leaf
        k, at = best[1]
        left = binned[rows, k] <= at
        return (k, float(cuts[k][at]), grow(rows[left], level - 1, g, h), grow(rows[~left], level - 1, g, h))

    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        root = grow(np.arange(len(y)), depth, w * (y - p), w * p * (1 - p))
        model.roots.append(root)
        total += Trees(model.names, 0.0, [root]).score(x)
    return model
