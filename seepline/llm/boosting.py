"""Gradient-boosted trees for two classes, on binned features, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass(frozen=True)
class Trees:
    """``cuts[f]`` are the bin edges of feature ``f``; a tree of depth ``d`` holds ``2**d - 1``
    splits in heap order (feature, largest bin that goes left) and ``2**d`` leaf values."""

    cuts: list[np.ndarray]
    base: float
    feature: np.ndarray
    bound: np.ndarray
    leaf: np.ndarray

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(self.cuts)], axis=1).astype(np.int16)

    def probability(self, x: np.ndarray) -> np.ndarray:
        b = self.binned(x)
        z = np.full(len(x), self.base)
        rows, inner = np.arange(len(x)), self.feature.shape[1]
        for feature, bound, leaf in zip(self.feature, self.bound, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            while len(at) and at[0] < inner:
                at = 2 * at + 1 + (b[rows, feature[at]] > bound[at])
            z += leaf[at - inner]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.25, ridge: float = 1.0, least: float = 2.0) -> Trees:
    """Newton boosting of the logistic loss; a split needs ``least`` curvature on both sides.
    Equal gains go to the first feature and bin, so that a fit is reproducible."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
    trees = Trees(cuts, 0.0, np.zeros((0, 1)), np.zeros((0, 1)), np.zeros((0, 1)))
    b = trees.binned(x)
    n, wide = b.shape
    flat = b + np.arange(wide) * BINS
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    z = np.full(n, base)
    inner = 2**depth - 1
    features, bounds, leaves = [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-z))
        g, h = y - p, p * (1 - p)
        at = np.zeros(n, np.int64)
        feature, bound = np.zeros(inner, np.int64), np.full(inner, BINS, np.int64)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            key = ((at - first)[:, None] * (wide * BINS) + flat).ravel()
            sums = [np.bincount(key, weights=np.repeat(v, wide), minlength=nodes * wide * BINS).reshape(nodes, wide, BINS).cumsum(axis=2) for v in (g, h)]
            gl, hl = sums
            gt, ht = gl[:, :1, -1:], hl[:, :1, -1:]
            gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
            gain[(hl < least) | (ht - hl < least)] = 0
            best = gain.reshape(nodes, -1).argmax(axis=1)
            use = gain.reshape(nodes, -1)[np.arange(nodes), best] > 1e-9
            feature[first : first + nodes] = np.where(use, best // BINS, 0)
            bound[first : first + nodes] = np.where(use, best % BINS, BINS)
            at = 2 * at + 1 + (b[np.arange(n), feature[at]] > bound[at])
        at -= inner
        value = rate * np.bincount(at, weights=g, minlength=inner + 1) / (np.bincount(at, weights=h, minlength=inner + 1) + ridge)
        z += value[at]
        features.append(feature)
        bounds.append(bound)
        leaves.append(value)
    return Trees(cuts, base, np.array(features), np.array(bounds), np.array(leaves))
