"""Histogram gradient-boosted trees for two classes, in numpy.

Features are cut into bins at quantiles; a tree is grown level by level on histograms of gradients and second derivatives of
the logistic loss. A feature may be constrained to raise (+1) or lower (-1) the score: a split on it is taken only if its
two leaves are ordered that way, and their mid value bounds everything below each side. A model is four flat arrays, and
all rows walk a tree at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Node k of tree t: rows with x[feature] <= threshold go to left, others to right; a leaf points to itself."""

    base: float
    depth: int
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            out += self.value[node]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, monotone: dict[int, int] | None = None, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 48, least: int = 8, ridge: float = 1.0) -> Trees:
    """Without rows of both classes the model is the share of ones, drawn towards one half by one row of each class."""
    monotone = monotone or {}
    n, f = x.shape if len(x) else (0, x.shape[1] if x.ndim == 2 else 1)
    prior = (y.sum() + 1) / (n + 2)
    base = float(np.log(prior / (1 - prior)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    if n and 0 < y.sum() < n:
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(f)]
        binned = np.stack([np.searchsorted(edges[j], x[:, j], "left") for j in range(f)], axis=1)
        wide = bins + 1
        score = np.full(n, base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p)
            roots.append(len(feature))

            def leaf(rows, lo, hi):
                feature.append(0), threshold.append(np.inf), left.append(len(value)), right.append(len(value))
                value.append(rate * float(np.clip(g[rows].sum() / (h[rows].sum() + ridge), lo, hi)))
                return len(value) - 1

            open_ = [(leaf(np.arange(n), -np.inf, np.inf), np.arange(n), -np.inf, np.inf)]
            for _ in range(depth):
                nxt = []
                for k, rows, lo, hi in open_:
                    if len(rows) < 2 * least:
                        continue
                    code = (binned[rows] + np.arange(f) * wide).ravel()
                    gs = np.bincount(code, np.repeat(g[rows], f), f * wide).reshape(f, wide).cumsum(axis=1)
                    hs = np.bincount(code, np.repeat(h[rows], f), f * wide).reshape(f, wide).cumsum(axis=1)
                    cs = np.bincount(code, minlength=f * wide).reshape(f, wide).cumsum(axis=1)
                    gt, ht = g[rows].sum(), h[rows].sum()
                    gain = gs**2 / (hs + ridge) + (gt - gs) ** 2 / (ht - hs + ridge) - gt**2 / (ht + ridge)
                    lv, rv = np.clip(gs / (hs + ridge), lo, hi), np.clip((gt - gs) / (ht - hs + ridge), lo, hi)
                    ok = (cs >= least) & (len(rows) - cs >= least)
                    for j, sign in monotone.items():
                        ok[j] &= sign * (rv[j] - lv[j]) >= 0
                    gain = np.where(ok, gain, -1)
                    j, b = divmod(int(gain.argmax()), wide)
                    if gain[j, b] <= 1e-6 or b >= len(edges[j]):
                        continue
                    go = binned[rows, j] <= b
                    mid, sign = (lv[j, b] + rv[j, b]) / 2, monotone.get(j, 0)
                    # Up to the split, and above it: the bounds of all that may be added there.
                    low, high = {0: ((lo, hi), (lo, hi)), 1: ((lo, mid), (mid, hi)), -1: ((mid, hi), (lo, mid))}[sign]
                    sides = ((rows[go], *low), (rows[~go], *high))
                    a, c = leaf(*sides[0]), leaf(*sides[1])
                    feature[k], threshold[k], left[k], right[k] = j, float(edges[j][b]), a, c
                    nxt += [(a, *sides[0]), (c, *sides[1])]
                open_ = nxt
            arrays = [np.array(v) for v in (feature, threshold, left, right, value)]
            score = score + Trees(0.0, depth, *arrays, np.array(roots[-1:])).raw(x)
    return Trees(base, depth, np.array(feature, np.int64), np.array(threshold, float), np.array(left, np.int64), np.array(right, np.int64), np.array(value, float), np.array(roots, np.int64))
