"""Gradient-boosted trees in numpy: logistic loss, histogram splits, monotonic constraints.

A fitted model is a handful of flat node arrays, so it travels with a task and scores whole batches
with array operations.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """Nodes of all trees in one run of arrays; ``roots`` has each tree's first node. A leaf has feature -1."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                f = self.feature[node]
                down = np.where(x[rows, np.maximum(f, 0)] <= self.threshold[node], self.left[node], self.right[node])
                node = np.where(f < 0, node, down)
            total += self.value[node]
        return total

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.raw(x)))


def constant(probability: float) -> Forest:
    p = min(max(probability, 1e-6), 1 - 1e-6)
    none = np.zeros(0, np.int64)
    return Forest(none, np.zeros(0), none, none, np.zeros(0), none, 0, float(np.log(p / (1 - p))))


def fit(
    x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2,
    bins: int = 48, l2: float = 1.0, least_weight: float = 1.0,
) -> Forest:
    """``monotone`` has +1 (may only rise with the feature), -1 (may only fall) or 0 for each feature."""
    n, k = x.shape
    share = float(y.mean()) if n else 1.0
    if n == 0 or share in (0.0, 1.0):
        return constant(share)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(k)]
    codes = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(k)], axis=1)
    width = bins + 1
    offset = np.arange(k) * width
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    base = float(np.log(share / (1 - share)))
    raw = np.full(n, base)

    def node() -> int:
        for a, v in ((feature, -1), (threshold, 0.0), (left, -1), (right, -1), (value, 0.0)):
            a.append(v)
        return len(feature) - 1

    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        root = node()
        roots.append(root)
        level = [(root, np.arange(n), -np.inf, np.inf)]
        for d in range(depth + 1):
            following = []
            for at, rows, low, high in level:
                gs, hs = g[rows].sum(), h[rows].sum()
                own = float(np.clip(gs / (hs + l2), low, high))
                value[at] = rate * own
                if d < depth and len(rows) >= 2:
                    split = _best(codes[rows], g[rows], h[rows], k, width, offset, monotone, low, high, l2, least_weight)
                    if split:
                        j, b, wl, wr = split
                        mid = (wl + wr) / 2
                        goes = codes[rows, j] <= b
                        feature[at], threshold[at] = j, float(edges[j][b])
                        left[at], right[at] = node(), node()
                        bounds = {1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid)), 0: ((low, high),) * 2}[int(monotone[j])]
                        following += [(left[at], rows[goes], *bounds[0]), (right[at], rows[~goes], *bounds[1])]
                        continue
                raw[rows] += value[at]
            level = following
    return Forest(np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value), np.array(roots), depth, base)


def _best(codes, g, h, k, width, offset, monotone, low, high, l2, least_weight):
    """(feature, last bin on the left, both weights) of the split with the largest gain, or None."""
    flat = (codes + offset).ravel()
    gs = np.bincount(flat, np.repeat(g, k), minlength=k * width).reshape(k, width).cumsum(axis=1)
    hs = np.bincount(flat, np.repeat(h, k), minlength=k * width).reshape(k, width).cumsum(axis=1)
    gt, ht = gs[:, -1:], hs[:, -1:]
    gl, hl = gs[:, :-1], hs[:, :-1]
    gr, hr = gt - gl, ht - hl
    wl, wr = np.clip(gl / (hl + l2), low, high), np.clip(gr / (hr + l2), low, high)
    score = lambda gg, hh, w: gg * w - (hh + l2) * w * w / 2
    whole = np.clip(gt / (ht + l2), low, high)
    gain = score(gl, hl, wl) + score(gr, hr, wr) - score(gt, ht, whole)
    sign = monotone[:, None]
    gain = np.where((hl >= least_weight) & (hr >= least_weight) & (sign * (wr - wl) >= 0), gain, 0)
    j, b = np.unravel_index(int(gain.argmax()), gain.shape)
    return (int(j), int(b), float(wl[j, b]), float(wr[j, b])) if gain[j, b] > 1e-6 else None
