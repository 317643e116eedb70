"""Gradient-boosted trees on a bounded sample, and isotonic calibration.

The sample is fitted on the driver (its size is a parameter of the caller). A model is a list of trees in plain
lists, so it can be sent to workers or turned into column expressions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class BoostParams:
    trees: int = 60
    depth: int = 3
    rate: float = 0.2
    bins: int = 64
    least_weight: float = 3.0  #: least sum of hessians in a leaf
    ridge: float = 1.0
    least_gain: float = 1e-3


@dataclass
class Trees:
    """Trees as nodes [feature, cut, left, right, value]; a row goes left if its feature is at most the cut."""

    base: float = 0.0
    trees: list[list[list[float]]] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for t in self.trees:
            nodes = np.array(t)
            at = np.zeros(len(x), dtype=np.int64)
            while True:
                n = nodes[at]
                inner = n[:, 0] >= 0
                if not inner.any():
                    break
                left = x[np.arange(len(x)), np.maximum(n[:, 0], 0).astype(np.int64)] <= n[:, 1]
                at = np.where(inner, np.where(left, n[:, 2], n[:, 3]).astype(np.int64), at)
            out += nodes[at, 4]
        return out

    def expression(self, columns: list[Column]) -> Column:
        """The margin as a column expression."""
        def node(t: list[list[float]], i: int) -> Column:
            f, cut, left, right, value = t[int(i)]
            if f < 0:
                return F.lit(float(value))
            return F.when(columns[int(f)] <= F.lit(float(cut)), node(t, left)).otherwise(node(t, right))

        total = F.lit(float(self.base))
        for t in self.trees:
            total = total + node(t, 0)
        return total


def boost(x: np.ndarray, y: np.ndarray, p: BoostParams = BoostParams()) -> Trees:
    """Trees for the log odds of y (0 or 1), by second-order boosting over quantile bins."""
    n, k = x.shape
    if not n:
        return Trees()
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    model = Trees(float(np.log(share / (1 - share))))
    if y.min() == y.max():
        return model
    cuts, codes = [], np.zeros((n, k), dtype=np.int64)
    for f in range(k):
        values = np.unique(x[:, f])
        if len(values) > p.bins:
            values = np.unique(np.quantile(x[:, f], np.linspace(0, 1, p.bins + 1)))
        mids = (values[:-1] + values[1:]) / 2
        cuts.append(mids)
        codes[:, f] = np.searchsorted(mids, x[:, f], side="left")
    margin = np.full(n, model.base)
    for _ in range(p.trees):
        prob = 1 / (1 + np.exp(-margin))
        g, h = prob - y, np.maximum(prob * (1 - prob), 1e-9)
        nodes: list[list[float]] = [[-1, 0, 0, 0, 0]]
        open_: list[tuple[int, np.ndarray, int]] = [(0, np.arange(n), 0)]
        while open_:
            i, rows, depth = open_.pop()
            gs, hs = g[rows].sum(), h[rows].sum()
            best = (p.least_gain, -1, 0)
            if depth < p.depth and hs >= 2 * p.least_weight:
                for f in range(k):
                    if not len(cuts[f]):
                        continue
                    size = len(cuts[f]) + 1
                    gl = np.cumsum(np.bincount(codes[rows, f], weights=g[rows], minlength=size))[:-1]
                    hl = np.cumsum(np.bincount(codes[rows, f], weights=h[rows], minlength=size))[:-1]
                    gain = gl**2 / (hl + p.ridge) + (gs - gl) ** 2 / (hs - hl + p.ridge) - gs**2 / (hs + p.ridge)
                    gain[(hl < p.least_weight) | (hs - hl < p.least_weight)] = -1
                    c = int(gain.argmax())
                    if gain[c] > best[0] * (1 + 1e-9):  # of equal gains, up to rounding, the first feature's
                        best = (float(gain[c]), f, c)
            if best[1] < 0:
                value = float(-gs / (hs + p.ridge) * p.rate)
                nodes[i][4] = value
                margin[rows] += value
                continue
            _, f, c = best
            left = codes[rows, f] <= c
            nodes[i][:4] = [f, float(cuts[f][c]), len(nodes), len(nodes) + 1]
            nodes += [[-1, 0, 0, 0, 0], [-1, 0, 0, 0, 0]]
            open_ += [(len(nodes) - 2, rows[left], depth + 1), (len(nodes) - 1, rows[~left], depth + 1)]
        model.trees.append(nodes)
    return model


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[list[float], list[float]]:
    """(scores, probabilities) of a non-decreasing calibration by pooling adjacent violators, at the blocks' ends.

    Between the points it is linear. Each block's share is drawn a little to the middle, so that none is 0 or 1.
    """
    if not len(score):
        return [0.0], [0.5]
    order = np.argsort(score, kind="stable")
    s, first = np.unique(score[order], return_index=True)
    ys = np.add.reduceat(y[order].astype(float), first)
    ns = np.diff(np.append(first, len(order))).astype(float)
    blocks: list[list[float]] = []  # sum, weight, lowest score, highest score
    for a, b, c in zip(ys, ns, s, strict=True):
        blocks.append([a, b, c, c])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2], last[3]]
    xs: list[float] = []
    ps: list[float] = []
    for a, b, lo, hi in blocks:
        p = (a + 0.5) / (b + 1)
        for v in dict.fromkeys((lo, hi)):
            xs.append(float(v))
            ps.append(max(float(p), ps[-1] if ps else 0.0))
    return xs, ps


def calibrated(xs: list[float], ps: list[float], score: np.ndarray) -> np.ndarray:
    return np.interp(score, xs, ps)


def out_of_fold(x: np.ndarray, y: np.ndarray, fold: np.ndarray, p: BoostParams = BoostParams()) -> np.ndarray:
    """Margins of each row by trees that weren't fitted on its fold."""
    out = np.zeros(len(y))
    for f in np.unique(fold):
        held = fold == f
        out[held] = boost(x[~held], y[~held], p).margin(x[held])
    return out
