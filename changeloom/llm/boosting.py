"""Gradient-boosted trees on a bounded sample of dense features, with isotonic calibration. Fits on the driver, scores in batches."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Tree:
    """A full binary tree of ``depth`` levels: features and thresholds in heap order, then the leaves' values."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        depth = (len(self.feature) + 1).bit_length() - 1
        node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(depth):
            node = 2 * node + 1 + (x[rows, self.feature[node]] > self.threshold[node])
        return self.value[node - len(self.feature)]


@dataclass
class Boosted:
    base: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    #: Isotonic calibration: raw margins and the probabilities there.
    at: np.ndarray = field(default_factory=lambda: np.array([-1.0, 1.0]))
    prob: np.ndarray = field(default_factory=lambda: np.array([0.25, 0.75]))

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for t in self.trees:
            out += t.predict(x)
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability; a small strictly rising part keeps the order of the margins within a step."""
        m = self.margin(x)
        p = np.interp(m, self.at, self.prob)
        return np.clip(0.999 * p + 0.001 / (1 + np.exp(-m)), 0.0, 1.0)


def _bins(x: np.ndarray, n_bins: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(c, np.linspace(0, 1, n_bins + 1)[1:-1])) for c in x.T]


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; each pool's rate is smoothed by half a success and half a failure."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # sum of x, sum of y, size
    for a, b in zip(x[order], y[order]):
        pools.append([a, b, 1.0])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last)]
    at = np.array([p[0] / p[2] for p in pools])
    rate = np.array([(p[1] + 0.5) / (p[2] + 1) for p in pools])
    return at, np.maximum.accumulate(rate)


def fit(x: np.ndarray, y: np.ndarray, *, rounds: int = 80, depth: int = 3, rate: float = 0.15, n_bins: int = 48, least: float = 1.0, ridge: float = 1.0, calibration: float = 0.25) -> Boosted:
    """Logistic loss, Newton leaves, histogram splits. Each fourth row (``calibration``) only calibrates."""
    held = np.arange(len(y)) % round(1 / calibration) == 0
    if len(y) < 40 or min(y[held].sum(), (1 - y[held]).sum()) < 3:
        held[:] = False
    xt, yt = x[~held], y[~held].astype(float)
    mean = (yt.sum() + 0.5) / (len(yt) + 1)
    model = Boosted(base=float(np.log(mean / (1 - mean))))
    if len(yt) and 0 < yt.sum() < len(yt):
        cuts = _bins(xt, n_bins)
        codes = np.stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, xt.T)])
        width = n_bins + 1
        margin = np.full(len(yt), model.base)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-margin))
            tree, node = _tree(codes, cuts, width, p - yt, p * (1 - p), depth, least, ridge, rate)
            model.trees.append(tree)
            margin += tree.value[node]
    if held.any():
        model.at, model.prob = isotonic(model.margin(x[held]), y[held].astype(float))
        if len(model.at) == 1:
            held[:] = False
    if not held.any():
        grid = np.linspace(-8, 8, 65)
        model.at, model.prob = grid, 1 / (1 + np.exp(-grid))
    return model


def _tree(codes: np.ndarray, cuts: list[np.ndarray], width: int, g: np.ndarray, h: np.ndarray, depth: int, least: float, ridge: float, rate: float) -> tuple[Tree, np.ndarray]:
    n_feat, inner = len(codes), 2**depth - 1
    feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
    node = np.zeros(codes.shape[1], np.int64)
    for level in range(depth):
        width_nodes = 2**level
        local = node - (width_nodes - 1)
        best = np.full(width_nodes, 1e-6)
        total_g, total_h = np.bincount(local, g, width_nodes), np.bincount(local, h, width_nodes)
        for f in range(n_feat):
            key = local * width + codes[f]
            gl = np.bincount(key, g, width_nodes * width).reshape(width_nodes, width).cumsum(axis=1)[:, : len(cuts[f])]
            hl = np.bincount(key, h, width_nodes * width).reshape(width_nodes, width).cumsum(axis=1)[:, : len(cuts[f])]
            if not gl.shape[1]:
                continue
            gr, hr = total_g[:, None] - gl, total_h[:, None] - hl
            gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - (total_g**2 / (total_h + ridge))[:, None]
            gain[(hl < least) | (hr < least)] = -1
            at = gain.argmax(axis=1)
            for k in np.nonzero(gain[np.arange(width_nodes), at] > best)[0]:
                best[k] = gain[k, at[k]]
                feature[width_nodes - 1 + k], threshold[width_nodes - 1 + k] = f, cuts[f][at[k]]
        right = np.zeros(len(node), bool)
        for k in range(width_nodes):
            i = width_nodes - 1 + k
            mine = local == k
            if np.isfinite(threshold[i]):
                right[mine] = codes[feature[i]][mine] > np.searchsorted(cuts[feature[i]], threshold[i], side="left")
        node = 2 * node + 1 + right
    leaf = node - inner
    value = -rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + ridge)
    return Tree(feature, threshold, value), leaf
