"""Gradient-boosted trees for a yes or no, on a table of numbers in memory or on a DataFrame of any size."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Gradients are summed as whole numbers of this part of one, so that the sums do not depend on the order of rows.
PARTS = 1 << 20


@dataclass
class Trees:
    """Complete binary trees of one depth: feature and threshold of inner nodes, value of leaves, level by level."""

    depth: int
    start: float = 0.0
    rate: float = 0.2
    features: list[np.ndarray] = field(default_factory=list)
    limits: list[np.ndarray] = field(default_factory=list)
    values: list[np.ndarray] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for feature, limit, value in zip(self.features, self.limits, self.values):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > limit[node])
            out += self.rate * value[node - (2 ** self.depth - 1)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _best_cut(x: np.ndarray, grid: list[np.ndarray], g: np.ndarray, h: np.ndarray, weight: float) -> tuple[int, float]:
    """Feature and threshold with the largest gain; a threshold of infinity sends everything left."""
    best, found = 1e-9, (0, np.inf)
    whole = g.sum() ** 2 / (h.sum() + weight)
    for f, limits in enumerate(grid):
        if not len(limits):
            continue
        place = np.searchsorted(limits, x[:, f], side="left")
        gain = _gains(np.bincount(place, weights=g, minlength=len(limits) + 1), np.bincount(place, weights=h, minlength=len(limits) + 1), weight, whole)
        k = int(gain.argmax())
        if gain[k] > best:
            best, found = gain[k], (f, float(limits[k]))
    return found


def _gains(g: np.ndarray, h: np.ndarray, weight: float, whole: float) -> np.ndarray:
    """The gain of a cut after each cell but the last, of sums by cell in the last axis."""
    gl, hl = np.cumsum(g, axis=-1), np.cumsum(h, axis=-1)
    gr, hr = gl[..., -1:] - gl, hl[..., -1:] - hl
    return (gl ** 2 / (hl + weight) + gr ** 2 / (hr + weight))[..., :-1] - whole


def boost(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.2, weight: float = 1.0) -> Trees:
    """Second-order boosting of the logistic loss; thresholds lie between distinct values, at most 32 per feature."""
    mean = np.clip(y.mean() if len(y) else 0.5, 1e-4, 1 - 1e-4)
    model = Trees(depth, float(np.log(mean / (1 - mean))), rate)
    grid = []
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        middle = (values[1:] + values[:-1]) / 2
        grid.append(middle if len(middle) <= 32 else np.unique(np.quantile(middle, np.linspace(0, 1, 32))))
    inner = 2 ** depth - 1
    for _ in range(trees if len(y) else 0):
        p = model.probability(x)
        g, h = y - p, p * (1 - p)
        feature, limit, node = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf), np.zeros(len(x), dtype=np.int64)
        for n in range(inner):
            own = node == n
            if own.any():
                feature[n], limit[n] = _best_cut(x[own], grid, g[own], h[own], weight)
                node[own] = 2 * n + 1 + (x[own, feature[n]] > limit[n])
        leaf = node - inner
        gs, hs = np.bincount(leaf, weights=g, minlength=inner + 1), np.bincount(leaf, weights=h, minlength=inner + 1)
        model.features.append(feature)
        model.limits.append(limit)
        model.values.append(gs / (hs + weight))
    return model


def cells(x: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """For each number how many of at most 255 ascending limits lie below it."""
    return np.searchsorted(limits, x, side="left").astype(np.uint8)


def _summed(model: Trees, feature: np.ndarray, limit: np.ndarray, level: int, width: int, size: int):
    """Gradients and curvatures by node of a level of the tree in growth, feature and cell; only the sums leave a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, below = 2 ** level, 2 ** level - 1
        g_all, h_all = np.zeros((width, nodes * size)), np.zeros((width, nodes * size))
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(-1, width)
            right, n = (batch.column(i).to_numpy().astype(np.float64) for i in (1, 2))
            p = model.probability(x)
            g, h = np.rint((right - n * p) * PARTS), np.rint(n * p * (1 - p) * PARTS)
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(level):
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > limit[node])
            first = (node - below) * size
            for f in range(width):
                g_all[f] += np.bincount(first + x[:, f], weights=g, minlength=nodes * size)
                h_all[f] += np.bincount(first + x[:, f], weights=h, minlength=nodes * size)
        place = np.flatnonzero((g_all != 0) | (h_all != 0))
        yield pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), *[pa.array(a.reshape(-1)[place].astype(np.int64)) for a in (g_all, h_all)]], ["place", "g", "h"])

    return run


def boost_rows(rows: DataFrame, limits: np.ndarray, width: int, trees: int = 40, depth: int = 3, rate: float = 0.2, weight: float = 1.0) -> Trees:
    """The trees of ``boost`` with the same limits for every feature, learned from all rows of a table, which stay where they are.

    ``rows(x, right, n)``: the ``width`` bytes of ``cells``, how many examples have them, and how many of these are a yes. The table is
    read once for each level of each tree and should be a kept one; the driver gets sums by node, feature and cell only.
    """
    total, yes = rows.agg(F.sum("n"), F.sum("right")).first()
    mean = float(np.clip(yes / total if total else 0.5, 1e-4, 1 - 1e-4))
    model = Trees(depth, float(np.log(mean / (1 - mean))), rate)                                  # its limits are numbers of cells until the end
    inner, size = 2 ** depth - 1, len(limits) + 1
    for _ in range(trees if total else 0):
        feature, limit, value = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf), np.zeros(inner + 1)
        for level in range(depth):
            nodes, below = 2 ** level, 2 ** level - 1
            sums = rows.select("x", "right", "n").mapInArrow(_summed(model, feature, limit, level, width, size), "place long, g long, h long")
            found = sums.groupBy("place").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()        # at most nodes x features x cells
            g, h = np.zeros(width * nodes * size), np.zeros(width * nodes * size)
            place = found["place"].to_numpy()
            g[place], h[place] = found["g"].to_numpy() / PARTS, found["h"].to_numpy() / PARTS
            g, h = g.reshape(width, nodes, size), h.reshape(width, nodes, size)
            for node in range(nodes):
                own_g, own_h = g[:, node], h[:, node]
                gain = _gains(own_g, own_h, weight, own_g[0].sum() ** 2 / (own_h[0].sum() + weight))
                f, k = np.unravel_index(int(gain.argmax()), gain.shape)
                cut = int(k) if gain[f, k] > 1e-9 else size
                if cut < size:
                    feature[below + node], limit[below + node] = f, cut
                if level == depth - 1:
                    value[2 * node] = own_g[f, :cut + 1].sum() / (own_h[f, :cut + 1].sum() + weight)
                    value[2 * node + 1] = own_g[f, cut + 1:].sum() / (own_h[f, cut + 1:].sum() + weight)
        model.features.append(feature)
        model.limits.append(limit)
        model.values.append(value)
    model.limits = [np.array([np.inf if np.isinf(k) else limits[int(k)] for k in limit]) for limit in model.limits]
    return model
