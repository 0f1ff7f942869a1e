"""Gradient-boosted trees for a binary label in numpy, with monotonic constraints, as flat node arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """Node arrays of all trees. A leaf is its own child; ``roots`` are the first node of each tree."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def raw(self, rows: np.ndarray) -> np.ndarray:
        """Log odds of each row: all rows walk down one tree level by level."""
        out = np.full(len(rows), self.base)
        every = np.arange(len(rows))
        for root in self.roots:
            node = np.full(len(rows), root)
            for _ in range(self.depth):
                goes_left = rows[every, self.feature[node]] <= self.threshold[node]
                node = np.where(goes_left, self.left[node], self.right[node])
            out += self.value[node]
        return out

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(rows), -50, 50)))


def fit(rows: np.ndarray, labels: np.ndarray, monotone: tuple[int, ...] = (), trees: int = 60, depth: int = 4,
        rate: float = 0.2, bins: int = 64, ridge: float = 1.0, least: float = 2.0) -> Forest:
    """Fit log odds of the label. ``monotone`` has, for each feature, 1 if the odds may only rise with it, -1 if only
    fall, 0 if free. Thresholds are quantiles of the rows; a split keeps the constraint by its two values, and
    each side stays on its side of their middle further down. Deterministic; one class alone gives no tree."""
    rows = np.asarray(rows, dtype=np.float64)
    labels = np.asarray(labels, dtype=np.float64)
    width = rows.shape[1]
    monotone = tuple(monotone) or (0,) * width
    share = (labels.sum() + 0.5) / (len(labels) + 1.0)
    forest = {"feature": [], "threshold": [], "left": [], "right": [], "value": []}
    roots: list[int] = []
    base = float(np.log(share / (1 - share)))
    if len(labels) and 0 < labels.sum() < len(labels):
        cuts = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(width)]
        binned = np.stack([np.searchsorted(c, rows[:, f], "left") for f, c in enumerate(cuts)], axis=1)
        score = np.full(len(labels), base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            roots.append(_grow(forest, binned, cuts, labels - p, p * (1 - p), monotone, depth, rate, ridge, least, score))
    kinds = {"feature": np.int64, "threshold": np.float64, "left": np.int64, "right": np.int64, "value": np.float64}
    return Forest(**{k: np.array(forest[k], dtype=kinds[k]) for k in forest}, roots=np.array(roots, dtype=np.int64), depth=depth, base=base)


def _grow(forest, binned, cuts, slope, curve, monotone, depth, rate, ridge, least, score) -> int:
    """Add one tree to the node arrays and its values to the score; returns its root."""

    def node(value: float) -> int:
        at = len(forest["value"])
        for name, x in (("feature", 0), ("threshold", np.inf), ("left", at), ("right", at), ("value", value)):
            forest[name].append(x)
        return at

    def weight(g, h, low, high):
        return np.clip(g / (h + ridge), low, high)

    def worth(g, h, w):
        return g * w - 0.5 * (h + ridge) * w * w

    def build(own: np.ndarray, low: float, high: float, left: int) -> int:
        g, h = slope[own].sum(), curve[own].sum()
        value = float(weight(g, h, low, high))
        at = node(rate * value)
        best = (1e-6, None)
        if left:
            for f, cut in enumerate(cuts):
                if not len(cut):
                    continue
                b = binned[own, f]
                gl = np.cumsum(np.bincount(b, slope[own], len(cut) + 1))[:-1]
                hl = np.cumsum(np.bincount(b, curve[own], len(cut) + 1))[:-1]
                wl, wr = weight(gl, hl, low, high), weight(g - gl, h - hl, low, high)
                gain = worth(gl, hl, wl) + worth(g - gl, h - hl, wr) - worth(g, h, value)
                gain[(hl < least) | (h - hl < least)] = -1
                if monotone[f]:
                    gain[(wr - wl) * monotone[f] < 0] = -1
                i = int(np.argmax(gain))
                if gain[i] > best[0]:
                    best = (float(gain[i]), (f, i, float(wl[i]), float(wr[i])))
        if best[1] is None:
            score[own] += rate * value
            return at
        f, i, wl, wr = best[1]
        goes = binned[own, f] <= i
        middle = (wl + wr) / 2
        bounds = ((low, high), (low, high)) if not monotone[f] else ((low, middle), (middle, high)) if monotone[f] > 0 else ((middle, high), (low, middle))
        forest["feature"][at], forest["threshold"][at] = f, float(cuts[f][i])
        forest["left"][at] = build(own[goes], *bounds[0], left - 1)
        forest["right"][at] = build(own[~goes], *bounds[1], left - 1)
        return at

    return build(np.arange(len(slope)), -np.inf, np.inf, depth)
