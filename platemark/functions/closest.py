"""Nearest points in NumPy: a balanced tree of boxes, searched for many points at a time."""

from __future__ import annotations

import numpy as np

#: Points of a leaf; points searched at a time, and nodes they may wait for before they are searched in two halves.
LEAF, BATCH, WAITING = 16, 8_192, 200_000


class Closest:
    """The nearest of ``x``, ``y`` to other points; of equally near ones the first.

    Every node is halved across its wider side. A point goes down to one leaf,
    which gives a bound, and from the top again to each node no farther than
    that, so the work doesn't depend on how the points are spread. Bounds are
    computed as distances are, so rounding loses no tie.
    """

    def __init__(self, x: np.ndarray, y: np.ndarray):
        n = len(x)
        self.depth = max(0, int(np.ceil(np.log2(max(1, n) / LEAF))))
        at = np.minimum(np.arange(-(-n // 2**self.depth) * 2**self.depth), n - 1)  # the last one again, so that all halves are equal
        at, self.low, self.high = at.reshape(1, -1), [], []
        for level in range(self.depth + 1):
            px, py = x[at], y[at]
            low, high = np.stack([px.min(1), py.min(1)]), np.stack([px.max(1), py.max(1)])
            self.low.append(low)
            self.high.append(high)
            if level < self.depth:
                half, wide = at.shape[1] // 2, high - low
                key = np.where((wide[0] >= wide[1])[:, None], px, py)
                at = np.take_along_axis(at, np.argpartition(key, half - 1, axis=1), 1).reshape(-1, half)
        self.at, self.x, self.y = at, x[at], y[at]

    def _apart(self, level: int, node: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Distance to a node's box; 0 within it."""
        low, high = self.low[level], self.high[level]
        dx = np.maximum(np.maximum(low[0][node] - x, x - high[0][node]), 0.0)
        dy = np.maximum(np.maximum(low[1][node] - y, y - high[1][node]), 0.0)
        return np.sqrt(dx * dx + dy * dy)

    def _distances(self, leaf: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        dx, dy = x[:, None] - self.x[leaf], y[:, None] - self.y[leaf]
        return np.sqrt(dx * dx + dy * dy)

    def search(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the nearest point, distance) for each of ``x``, ``y``."""
        parts = [self._search(x[i : i + BATCH], y[i : i + BATCH]) for i in range(0, len(x), BATCH)]
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True)) if parts else (np.empty(0, int), np.empty(0))

    def _search(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        leaf = np.zeros(len(x), int)
        for level in range(1, self.depth + 1):
            leaf = 2 * leaf + (self._apart(level, 2 * leaf + 1, x, y) < self._apart(level, 2 * leaf, x, y))
        bound = self._distances(leaf, x, y).min(1)
        who, node = np.arange(len(x)), np.zeros(len(x), int)
        for level in range(1, self.depth + 1):
            who, node = np.repeat(who, 2), (2 * node[:, None] + [0, 1]).ravel()
            near = self._apart(level, node, x[who], y[who]) <= bound[who]
            who, node = who[near], node[near]
            if len(who) > WAITING and len(x) > 1:
                half = len(x) // 2
                return tuple(np.concatenate(p) for p in zip(self._search(x[:half], y[:half]), self._search(x[half:], y[half:]), strict=True))
        distance, best = np.full(len(x), np.inf), np.full(len(x), self.at.max() + 1)
        d = self._distances(node, x[who], y[who])
        np.minimum.at(distance, who, d.min(1))
        np.minimum.at(best, who, np.where(d == distance[who][:, None], self.at[node], self.at.max() + 1).min(1))
        return best, distance
