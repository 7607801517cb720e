"""Bidirectional gated recurrent network over bytes, in numpy.

Two recurrent layers read a short run of bytes from both ends; at every byte their joined
states give the probabilities of the classes. Trained by backpropagation through time.
"""

from __future__ import annotations

import numpy as np

START, STOP = 256, 257
SYMBOLS = 258


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-x))


def packed(runs: list[bytes], steps: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbols by row and step, lengths); step 0 of each row is its first byte."""
    lengths = np.array([len(r) for r in runs], np.int64)
    grid = np.full((len(runs), steps), STOP, np.int64)
    flat = np.frombuffer(b"".join(runs), np.uint8)
    grid[np.arange(steps)[None, :] < lengths[:, None]] = flat
    return grid, lengths


class ByteNetwork:
    def __init__(self, classes: int, hidden: int = 16, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.hidden, self.classes = hidden, classes
        h3 = 3 * hidden
        self.p = {}
        for d in "fb":
            self.p[f"x{d}"] = rng.normal(0, 0.3, (SYMBOLS, h3))
            self.p[f"u{d}"] = rng.normal(0, hidden**-0.5, (hidden, h3))
            self.p[f"n{d}"] = np.zeros(hidden)
        self.p["o"] = rng.normal(0, 0.1, (2 * hidden, classes))
        self.p["c"] = np.zeros(classes)

    def _forward(self, d: str, grid: np.ndarray, keep: bool):
        """States after each step; ``keep``: also what the way back needs."""
        x, u, n = self.p[f"x{d}"], self.p[f"u{d}"], self.p[f"n{d}"]
        h = self.hidden
        start = np.zeros((1, h), x.dtype)
        state = np.repeat(self._step(start, x[[START]], u, n)[0], len(grid), axis=0)
        first = state
        states, trail = np.empty((grid.shape[1], len(grid), h), x.dtype), []
        for t in range(grid.shape[1]):
            new, kept = self._step(state, x[grid[:, t]], u, n)
            if keep:
                trail.append((state, *kept))
            state = states[t] = new
        return states, trail, first

    def _step(self, state, x, u, n):
        h = self.hidden
        s = state @ u
        gates = _sigmoid(x[:, : 2 * h] + s[:, : 2 * h])
        z, r = gates[:, :h], gates[:, h:]
        inner = s[:, 2 * h :] + n
        new = np.tanh(x[:, 2 * h :] + r * inner)
        return new + z * (state - new), (z, r, inner, new)

    @staticmethod
    def _turned(grid: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Each row's bytes in reverse order, still at its beginning."""
        steps = np.arange(grid.shape[1])[None, :]
        at = np.where(steps < lengths[:, None], lengths[:, None] - 1 - steps, steps)
        return np.take_along_axis(grid, at, axis=1)

    def _both(self, grid, lengths, keep=False):
        f, f_trail, f0 = self._forward("f", grid, keep)
        b, b_trail, b0 = self._forward("b", self._turned(grid, lengths), keep)
        steps = np.arange(grid.shape[1])[:, None]
        at = np.where(steps < lengths[None, :], lengths[None, :] - 1 - steps, steps)
        joined = np.concatenate((f, np.take_along_axis(b, at[:, :, None], axis=0)), axis=2)
        return joined, at, (f_trail, f0), (b_trail, b0)

    def probabilities(self, grid: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """(step, row, class); steps beyond a row's length have no meaning."""
        joined, *_ = self._both(grid, lengths)
        logits = joined @ self.p["o"] + self.p["c"]
        logits -= logits.max(axis=2, keepdims=True)
        e = np.exp(logits)
        return e / e.sum(axis=2, keepdims=True)

    def gradients(self, grid, lengths, labels) -> tuple[float, dict[str, np.ndarray]]:
        """(mean loss over all bytes, gradients) for one class label per row."""
        joined, at, (f_trail, _), (b_trail, _) = self._both(grid, lengths, keep=True)
        logits = joined @ self.p["o"] + self.p["c"]
        logits -= logits.max(axis=2, keepdims=True)
        e = np.exp(logits)
        prob = e / e.sum(axis=2, keepdims=True)
        live = (np.arange(grid.shape[1])[:, None] < lengths[None, :])[:, :, None]
        total = max(1, int(lengths.sum()))
        rows = np.arange(len(grid))
        loss = float(-(np.log(prob[:, rows, labels] + 1e-30) * live[:, :, 0]).sum() / total)
        delta = prob.copy()
        delta[:, rows, labels] -= 1
        delta *= live / total
        h = self.hidden
        g = {"o": joined.reshape(-1, 2 * h).T @ delta.reshape(-1, self.classes), "c": delta.sum((0, 1))}
        back = delta @ self.p["o"].T
        down_f, down_b = back[:, :, :h], np.take_along_axis(back[:, :, h:], at[:, :, None], axis=0)
        self._backward("f", grid, f_trail, down_f, g)
        self._backward("b", self._turned(grid, lengths), b_trail, down_b, g)
        return loss, g

    def _backward(self, d, grid, trail, down, g):
        x, u, n = self.p[f"x{d}"], self.p[f"u{d}"], self.p[f"n{d}"]
        h = self.hidden
        gx, gu, gn = np.zeros_like(x), np.zeros_like(u), np.zeros_like(n)

        def through(dh, state, z, r, inner, new):
            d_new = dh * (1 - z) * (1 - new * new)
            d_z = dh * (state - new) * z * (1 - z)
            d_r = d_new * inner * r * (1 - r)
            to_x = np.concatenate((d_z, d_r, d_new), axis=1)
            to_s = np.concatenate((d_z, d_r, d_new * r), axis=1)
            return to_x, to_s, d_new * r, dh * z + to_s @ u.T

        dh = np.zeros_like(down[0])
        for t in range(len(trail) - 1, -1, -1):
            to_x, to_s, to_n, before = through(dh + down[t], *trail[t])
            np.add.at(gx, grid[:, t], to_x)
            gu += trail[t][0].T @ to_s
            gn += to_n.sum(0)
            dh = before
        start = np.zeros((1, h), x.dtype)
        _, kept = self._step(start, x[[START]], u, n)
        to_x, to_s, to_n, _ = through(dh.sum(0, keepdims=True), start, *kept)
        gx[START] += to_x[0]
        gn += to_n[0]
        g[f"x{d}"], g[f"u{d}"], g[f"n{d}"] = gx, gu, gn

    def train(self, runs, labels, weights, steps: int, rounds: int, batch: int = 512, rate: float = 0.01, seed: int = 2):
        """Adam over batches drawn by ``weights``; the rate falls to zero."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        for i in range(1, rounds + 1):
            pick = rng.choice(len(runs), batch, p=weights)
            grid, lengths = packed([runs[j] for j in pick], steps)
            grid = grid[:, : max(1, int(lengths.max()))]
            _, g = self.gradients(grid, lengths, labels[pick])
            step = rate * (1 - (i - 1) / rounds)
            for k in self.p:
                m[k] += 0.1 * (g[k] - m[k])
                v[k] += 0.01 * (g[k] * g[k] - v[k])
                self.p[k] -= step * (m[k] / (1 - 0.9**i)) / (np.sqrt(v[k] / (1 - 0.99**i)) + 1e-8)
        return self

    def single(self) -> ByteNetwork:
        """The network in single precision, for prediction."""
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        return self
