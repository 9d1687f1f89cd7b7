"""Gradient-boosted trees in numpy, flattened into node arrays, with monotonic constraints.

Fitting grows trees of a fixed depth on binned features for the logistic loss. A constrained
feature may only split so that the score moves its way, and the children of such a split keep
to either side of its middle, so that the whole tree is monotonic in it. A fitted model is six
arrays; scoring walks all rows down all trees at once, one level at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Node i tests feature[i] <= threshold[i]; leaves point at themselves."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def margin(self, rows: np.ndarray) -> np.ndarray:
        if not len(self.roots):
            return np.full(len(rows), self.base)
        at = np.broadcast_to(self.roots, (len(rows), len(self.roots))).copy()
        row = np.arange(len(rows))[:, None]
        for _ in range(self.depth):
            at = np.where(rows[row, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.base + self.value[at].sum(axis=1)

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(rows)))


class _Grower:
    def __init__(self, depth: int, l2: float, least: int, signs: np.ndarray):
        self.depth, self.l2, self.least, self.signs = depth, l2, least, signs
        self.nodes: list[list[float]] = []

    def grow(self, bins, cuts, grad, hess, rows, level, low, high) -> int:
        at = len(self.nodes)
        value = float(np.clip(-grad[rows].sum() / (hess[rows].sum() + self.l2), low, high))
        self.nodes.append([0, np.inf, at, at, value])
        split = self._best(bins, cuts, grad, hess, rows, low, high) if level < self.depth else None
        if split:
            feature, cut, left_value, right_value = split
            goes = bins[rows, feature] <= cut
            sign, middle = self.signs[feature], (left_value + right_value) / 2
            bounds = {0: (low, high, low, high), 1: (low, middle, middle, high), -1: (middle, high, low, middle)}[int(sign)]
            left = self.grow(bins, cuts, grad, hess, rows[goes], level + 1, *bounds[:2])
            right = self.grow(bins, cuts, grad, hess, rows[~goes], level + 1, *bounds[2:])
            self.nodes[at] = [feature, cuts[feature][cut], left, right, 0.0]
        return at

    def _best(self, bins, cuts, grad, hess, rows, low, high):
        if len(rows) < 2 * self.least:
            return None
        g, h = grad[rows].sum(), hess[rows].sum()
        best, found = 1e-6, None
        for f in range(bins.shape[1]):
            n = len(cuts[f])
            if not n:
                continue
            own = bins[rows, f]
            gl, hl = (np.cumsum(np.bincount(own, w, n + 1))[:-1] for w in (grad[rows], hess[rows]))
            nl = np.cumsum(np.bincount(own, minlength=n + 1))[:-1]
            vl = np.clip(-gl / (hl + self.l2), low, high)
            vr = np.clip(-(g - gl) / (h - hl + self.l2), low, high)
            gain = gl**2 / (hl + self.l2) + (g - gl) ** 2 / (h - hl + self.l2) - g**2 / (h + self.l2)
            allowed = (nl >= self.least) & (len(rows) - nl >= self.least) & (self.signs[f] * (vr - vl) >= 0)
            gain = np.where(allowed, gain, 0)
            cut = int(np.argmax(gain))
            if gain[cut] > best:
                best, found = gain[cut], (f, cut, float(vl[cut]), float(vr[cut]))
        return found


def fit(
    rows: np.ndarray,
    labels: np.ndarray,
    signs: np.ndarray,
    rounds: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    l2: float = 1.0,
    least: int = 5,
    bins: int = 64,
) -> Trees:
    """Trees for 0/1 ``labels``; signs holds 1, -1 or 0 for each feature. One class alone: no trees."""
    rows, labels = np.asarray(rows, float), np.asarray(labels, float)
    share = float(np.clip(labels.mean() if len(labels) else 0.5, 1e-3, 1 - 1e-3))
    base = float(np.log(share / (1 - share)))
    out, roots = [], []
    if 0 < labels.sum() < len(labels):
        cuts = [np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for x in rows.T]
        binned = np.column_stack([np.searchsorted(c, x, "left") for c, x in zip(cuts, rows.T)])
        margin = np.full(len(labels), base)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-margin))
            grower = _Grower(depth, l2, least, signs)
            grower.grow(binned, cuts, p - labels, p * (1 - p), np.arange(len(labels)), 0, -np.inf, np.inf)
            tree = _flat([grower.nodes], [0], 0.0, depth, rate)
            margin = margin + tree.margin(rows)
            out.append(grower.nodes)
            roots.append(sum(map(len, out[:-1])))
    return _flat(out, roots, base, depth, rate)


def _flat(trees: list[list], roots: list[int], base: float, depth: int, rate: float) -> Trees:
    nodes = [[f, t, a + k, b + k, v] for k, tree in zip(roots, trees) for f, t, a, b, v in tree]
    table = np.array(nodes, float).reshape(-1, 5)
    f, a, b = (table[:, i].astype(np.int64) for i in (0, 2, 3))
    return Trees(f, table[:, 1], a, b, table[:, 4] * rate, np.array(roots, np.int64), base, depth)
