"""Histogram gradient-boosted trees for a yes-or-no target, on numpy arrays.

Fitting takes a bounded sample on the driver. The fitted model is a handful of flat
arrays, so that scoring walks all trees of all rows at once, level by level, and the
model travels to the tasks as a few kilobytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Node k: go to ``left[k]`` if x[feature[k]] <= threshold[k], else to left[k] + 1.

    A leaf leads to itself in any case (threshold infinite). ``roots`` has the root of each tree.
    """

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        """The log-odds of each row."""
        total = np.full(len(x), self.start)
        for low in range(0, len(x), 4096):
            part = x[low : low + 4096]
            node = np.broadcast_to(self.roots, (len(part), len(self.roots)))
            rows = np.arange(len(part))[:, None]
            for _ in range(self.depth):
                node = self.left[node] + (part[rows, self.feature[node]] > self.threshold[node])
            total[low : low + 4096] += self.value[node].sum(axis=1)
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of a yes, between 0 and 1."""
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds between distinct values, at most bins - 1."""
    distinct = np.unique(column)
    if len(distinct) > bins:
        distinct = np.unique(np.quantile(column, np.linspace(0, 1, bins), method="nearest"))
    return (distinct[:-1].astype(np.float64) + distinct[1:]) / 2


def fit(
    x: np.ndarray,
    y: np.ndarray,
    trees: int = 60,
    depth: int = 4,
    rate: float = 0.2,
    bins: int = 64,
    least: float = 4.0,
    ridge: float = 1.0,
    monotone: dict[int, int] | None = None,
) -> Trees:
    """Boost trees on the logistic loss.

    ``monotone`` maps a feature to +1 or -1: the score then never falls, or never
    rises, with it. A split against the direction is not taken, and the halves may
    not cross the middle of the split further down. Without rows, or with one class
    only, the model is a constant.
    """
    n, width = x.shape
    rate_yes = (y.sum() + 0.5) / (n + 1)
    start = float(np.log(rate_yes / (1 - rate_yes)))
    feature, threshold, left, value, roots = [], [], [], [], []

    def leaf(v: float = 0.0) -> int:
        feature.append(0)
        threshold.append(np.inf)
        left.append(len(left))
        value.append(v)
        return len(feature) - 1

    one_sided = n == 0 or y.min() == y.max()
    edges = [np.zeros(0)] * width if one_sided else [_edges(x[:, f], bins) for f in range(width)]
    binned = np.column_stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(width)]) if n else np.zeros((0, width), int)
    sign = np.zeros(width, int)
    for f, s in (monotone or {}).items():
        sign[f] = s
    raw = np.full(n, start)
    column = np.arange(width) * bins
    allowed = np.arange(bins)[None, :] < np.array([len(e) for e in edges])[:, None]  # a split after this bin
    for _ in range(0 if one_sided else trees):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-6)
        root = leaf()
        roots.append(root)
        active = [(root, np.arange(n), -np.inf, np.inf)]
        for _ in range(depth):
            following = []
            for node, rows, low, high in active:
                cells = (binned[rows] + column).ravel()
                g = np.bincount(cells, np.repeat(grad[rows], width), width * bins).reshape(width, bins).cumsum(axis=1)
                h = np.bincount(cells, np.repeat(hess[rows], width), width * bins).reshape(width, bins).cumsum(axis=1)
                gt, ht = g[0, -1], h[0, -1]
                vl = np.clip(-g / (h + ridge), low, high)
                vr = np.clip(-(gt - g) / (ht - h + ridge), low, high)
                vp = np.clip(-gt / (ht + ridge), low, high)
                loss = lambda s, k, v: s * v + 0.5 * (k + ridge) * v * v
                gain = loss(gt, ht, vp) - loss(g, h, vl) - loss(gt - g, ht - h, vr)
                ok = allowed & (h >= least * 0.05) & (ht - h >= least * 0.05) & (sign[:, None] * (vr - vl) >= 0)
                gain = np.where(ok, gain, -np.inf)
                f, b = np.unravel_index(np.argmax(gain), gain.shape)
                if not gain[f, b] > 1e-6:
                    continue
                goes_right = binned[rows, f] > b
                feature[node], threshold[node] = int(f), float(edges[f][b])
                a, c = leaf(float(vl[f, b])), leaf(float(vr[f, b]))
                left[node] = a
                middle = (vl[f, b] + vr[f, b]) / 2
                bounds = [(low, high), (low, high)]
                if sign[f]:
                    below, above = (low, middle), (middle, high)
                    bounds = [below, above] if sign[f] > 0 else [above, below]
                following += [(a, rows[~goes_right], *bounds[0]), (c, rows[goes_right], *bounds[1])]
            active = following
        node = np.full(n, root)
        fe, th, le = np.array(feature), np.array(threshold), np.array(left)
        for _ in range(depth):
            node = le[node] + (x[np.arange(n), fe[node]] > th[node])
        raw += rate * np.array(value)[node]
    if not roots:
        roots.append(leaf())
    return Trees(
        np.array(feature), np.array(threshold), np.array(left), np.array(value) * rate, np.array(roots), depth, start
    )
