"""Generalised additive model with pairwise interactions, in numpy.

Every feature is cut into bins at its quantiles. Shallow trees are boosted in cycles, one
feature at a time and with small steps, so that each feature ends as a table of scores by bin;
the pairs of features with the largest remaining gain get tables of their own in the same way.
A score is the sum of looked-up values.
"""

from __future__ import annotations

import numpy as np

BINS = 48
PAIR_BINS = 8
RATE = 0.08
ROUNDS = 150
PAIRS = 6
PAIR_ROUNDS = 40
CALM = 4.0  # added to every leaf's weight


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.empty(0)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + CALM)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """(gain, bins on the left) of the best division of binned sums."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
    at = int(gain.argmax())
    return float(gain[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Values by bin of a tree with at most ``leaves`` leaves over binned sums."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        found = [(*_best_cut(g[a:b], h[a:b]), i) for i, (a, b) in enumerate(parts)]
        gain, cut, i = max(found)
        if gain <= 1e-9:
            break
        a, b = parts[i]
        parts[i : i + 1] = [(a, a + cut), (a + cut, b)]
    out = np.empty(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + CALM)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, values) of the best four quadrants over a table of sums."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    best, at = -1.0, (1, 1)
    for i in range(g.shape[0] - 1):
        for j in range(g.shape[1] - 1):
            gain = 0.0
            for a, b in _quadrants(cg, ch, i, j):
                gain += a * a / (b + CALM)
            if gain > best:
                best, at = gain, (i + 1, j + 1)
    out = np.empty(g.shape)
    for si in (slice(0, at[0]), slice(at[0], None)):
        for sj in (slice(0, at[1]), slice(at[1], None)):
            out[si, sj] = g[si, sj].sum() / (h[si, sj].sum() + CALM)
    return best - float(_gain(g.sum(), h.sum())), out


def _quadrants(cg: np.ndarray, ch: np.ndarray, i: int, j: int):
    for c in ((cg, ch),):
        g, h = c
        yield g[i, j], h[i, j]
        yield g[-1, j] - g[i, j], h[-1, j] - h[i, j]
        yield g[i, -1] - g[i, j], h[i, -1] - h[i, j]
        yield g[-1, -1] - g[-1, j] - g[i, -1] + g[i, j], h[-1, -1] - h[-1, j] - h[i, -1] + h[i, j]


class AdditiveModel:
    def fit(self, x: np.ndarray, y: np.ndarray) -> AdditiveModel:
        n, features = x.shape
        self.cuts = [_cuts(x[:, f], BINS) for f in range(features)]
        self.coarse = [_cuts(x[:, f], PAIR_BINS) for f in range(features)]
        self.tables = [np.zeros(len(c) + 1) for c in self.cuts]
        self.pairs: list[tuple[int, int, np.ndarray]] = []
        rate = (y.sum() + 1.0) / (n + 2.0)
        self.base = float(np.log(rate / (1 - rate)))
        if not n:
            return self
        total = np.full(n, self.base)
        bins = [np.searchsorted(c, x[:, f], "right") for f, c in enumerate(self.cuts)]
        for _ in range(ROUNDS):
            for f in range(features):
                p = _sigmoid(total)
                size = len(self.tables[f])
                step = RATE * _tree(np.bincount(bins[f], y - p, size), np.bincount(bins[f], p * (1 - p), size))
                self.tables[f] += step
                total += step[bins[f]]
        low = [np.searchsorted(c, x[:, f], "right") for f, c in enumerate(self.coarse)]

        def sums(a: int, b: int):
            p = _sigmoid(total)
            shape = len(self.coarse[a]) + 1, len(self.coarse[b]) + 1
            place = low[a] * shape[1] + low[b]
            g = np.bincount(place, y - p, shape[0] * shape[1]).reshape(shape)
            return g, np.bincount(place, p * (1 - p), shape[0] * shape[1]).reshape(shape)

        wide = [f for f in range(features) if len(self.coarse[f])]
        gains = [(_pair_tree(*sums(a, b))[0], a, b) for i, a in enumerate(wide) for b in wide[i + 1 :]]
        chosen = [(a, b) for _, a, b in sorted(gains, reverse=True)[:PAIRS]]
        found = {p: 0.0 for p in chosen}
        for _ in range(PAIR_ROUNDS):
            for a, b in chosen:
                step = RATE * _pair_tree(*sums(a, b))[1]
                found[a, b] = found[a, b] + step
                total += step[low[a], low[b]]
        self.pairs = [(a, b, t) for (a, b), t in found.items()]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for f, (cuts, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            total += table[np.searchsorted(cuts, x[:, f], "right")]
        for a, b, table in self.pairs:
            total += table[np.searchsorted(self.coarse[a], x[:, a], "right"), np.searchsorted(self.coarse[b], x[:, b], "right")]
        return _sigmoid(total)
