"""A small convolutional network over bytes, in numpy.

Symbols are small integers (bytes, or bytes with a flag bit).  A filter of
width w holds one weight per tap and symbol, so a convolution is a sum of table
rows; all widths are even, and for prediction two taps are folded into one
table indexed by symbol pairs.  Filters are max-pooled over any span, rectified
and combined by one dense layer (softmax; two classes give a probability).
Only the positions that won the pooling get a gradient, so training touches few
weights per step.
"""

from __future__ import annotations

import uuid

import numpy as np

WIDTHS = (2, 4, 6)
OVERLAP = max(WIDTHS)  # neighbouring spans share this many symbols, so no window of symbols is lost between them
PAD = 0


def chunked(x: np.ndarray, length: int) -> np.ndarray:
    """Rows of ``length`` symbols that overlap by ``OVERLAP`` and cover all of ``x`` (padded at its end)."""
    step = length - OVERLAP
    n = max(1, -(-(len(x) - OVERLAP) // step))
    full = np.full(n * step + OVERLAP, PAD, x.dtype)
    full[: len(x)] = x
    return np.lib.stride_tricks.sliding_window_view(full, length)[::step]


class ByteConv:
    def __init__(self, symbols: int, filters: int, classes: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.symbols, self.filters, self.classes = symbols, filters, classes
        self.p = {f"t{w}": (rng.standard_normal((w, symbols, filters)) * 0.15).astype(np.float32) for w in WIDTHS}
        self.p |= {f"b{w}": np.zeros(filters, np.float32) for w in WIDTHS}
        self.p["dense"] = (rng.standard_normal((len(WIDTHS) * filters, classes)) * 0.1).astype(np.float32)
        self.p["bias"] = np.zeros(classes, np.float32)
        self._pairs: dict[int, list[np.ndarray]] | None = None

    # ---- prediction -------------------------------------------------------
    def freeze(self) -> ByteConv:
        """Fold neighbouring taps into tables over symbol pairs."""
        self._pairs = {}
        for w in WIDTHS:
            t = self.p[f"t{w}"]
            self._pairs[w] = [(t[k][:, None, :] + t[k + 1][None, :, :]).reshape(-1, self.filters) for k in range(0, w, 2)]
        return self

    def pooled(self, rows: np.ndarray) -> np.ndarray:
        """Maximum over each row's positions: (rows, widths * filters), before the bias."""
        assert self._pairs is not None
        done = []
        for low in range(0, len(rows), 64):  # few rows at a time stay in the CPU's cache
            part = rows[low : low + 64]
            pair = part[:, :-1].astype(np.intp) * self.symbols + part[:, 1:]
            out = []
            for w in WIDTHS:
                n = pair.shape[1] - w + 2
                z = self._pairs[w][0].take(pair[:, :n], axis=0, mode="clip")
                for k, tab in enumerate(self._pairs[w][1:], 1):
                    z += tab.take(pair[:, 2 * k : 2 * k + n], axis=0, mode="clip")
                while n > 1:  # halving is faster than a reduction over the middle axis
                    half = n // 2
                    np.maximum(z[:, :half], z[:, n - half : n], out=z[:, :half])
                    n -= half
                out.append(z[:, 0])
            done.append(np.concatenate(out, axis=1))
        return np.concatenate(done)

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        h = np.maximum(pooled + np.concatenate([self.p[f"b{w}"] for w in WIDTHS]), 0)
        return h @ self.p["dense"] + self.p["bias"]

    # ---- training ---------------------------------------------------------
    def _forward(self, rows: np.ndarray, starts: np.ndarray):
        """Pooled values of each group of rows (``starts``: first row of each) and where they were found."""
        best, where = [], []
        size = np.diff(np.append(starts, len(rows)))
        owner = np.repeat(np.arange(len(starts)), size)
        for w in WIDTHS:
            t = self.p[f"t{w}"]
            n = rows.shape[1] - w + 1
            z = t[0][rows[:, :n]]
            for k in range(1, w):
                z += t[k][rows[:, k : k + n]]
            at = z.argmax(axis=1)
            top = np.take_along_axis(z, at[:, None, :], axis=1)[:, 0]
            group = np.maximum.reduceat(top, starts, axis=0)
            hit = top == group[owner]
            row = np.where(hit, np.arange(len(rows))[:, None], len(rows))
            row = np.minimum.reduceat(row, starts, axis=0)
            best.append(group)
            where.append((row, np.take_along_axis(at, row, axis=0)))
        return np.concatenate(best, axis=1), where

    def gradients(self, rows: np.ndarray, starts: np.ndarray, labels: np.ndarray, decay: float) -> dict[str, np.ndarray]:
        """Of the mean cross entropy of the groups, plus ``decay / 2`` times the dense layer's sum of squares."""
        pooled, where = self._forward(rows, starts)
        b = np.concatenate([self.p[f"b{w}"] for w in WIDTHS])
        h = np.maximum(pooled + b, 0)
        z = h @ self.p["dense"] + self.p["bias"]
        z -= z.max(axis=1, keepdims=True)
        prob = np.exp(z)
        prob /= prob.sum(axis=1, keepdims=True)
        prob[np.arange(len(labels)), labels] -= 1
        prob /= len(labels)
        grad = {"dense": h.T @ prob + decay * self.p["dense"], "bias": prob.sum(axis=0)}
        back = (prob @ self.p["dense"].T) * (h > 0)
        f = self.filters
        for i, w in enumerate(WIDTHS):
            g = back[:, i * f : (i + 1) * f]
            row, at = where[i]
            t = np.zeros_like(self.p[f"t{w}"])
            col = np.broadcast_to(np.arange(f), g.shape)
            for k in range(w):
                np.add.at(t[k], (rows[row, at + k], col), g)
            grad[f"t{w}"], grad[f"b{w}"] = t, g.sum(axis=0)
        return grad

    def fit(self, groups: list[np.ndarray], labels: np.ndarray, epochs: int, batch_symbols: int, rate: float = 0.01, seed: int = 7, decay: float = 1e-4) -> ByteConv:
        """``groups``: the rows of each example; ``labels``: its class.  Adam, in a shuffled order fixed by ``seed``."""
        rng = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, total = 0, None
        cost = np.array([g.size for g in groups])
        batch_symbols = max(1, min(batch_symbols, int(cost.sum()) // 40))  # small sets still take some steps
        for epoch in range(epochs):
            order = rng.permutation(len(groups))
            batch_of = np.cumsum(cost[order]) // batch_symbols
            cuts = np.flatnonzero(np.diff(batch_of)) + 1
            batches = np.split(order, cuts)
            total = total or len(batches) * epochs
            for ids in batches:
                rows = np.concatenate([groups[i] for i in ids]).astype(np.int64)  # only a batch is this wide
                starts = np.concatenate([[0], np.cumsum([len(groups[i]) for i in ids])[:-1]])
                grad = self.gradients(rows, starts, labels[ids], decay)
                step += 1
                lr = rate * (1 - step / (total + 1)) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                for k, g in grad.items():
                    mean[k] += 0.1 * (g - mean[k])
                    square[k] += 0.001 * (g * g - square[k])
                    self.p[k] -= (lr * mean[k] / (np.sqrt(square[k]) + 1e-8)).astype(np.float32)
        return self.freeze()


_FROZEN: dict[str, ByteConv] = {}


class Shipped:
    """A fitted network as tasks get it: the raw weights; pair tables are built once per worker."""

    def __init__(self, net: ByteConv):
        self.key = uuid.uuid4().hex
        self.shape = (net.symbols, net.filters, net.classes)
        self.weights = {k: v.astype(np.float32) for k, v in net.p.items()}

    def net(self) -> ByteConv:
        if self.key not in _FROZEN:
            _FROZEN.clear()
            fresh = ByteConv(*self.shape)
            fresh.p = self.weights
            _FROZEN[self.key] = fresh.freeze()
        return _FROZEN[self.key]


def spread_bytes(raw: bytes, most: int, piece: int = 512) -> bytes:
    """All of ``raw``, or evenly spaced pieces of it that fill ``most`` bytes (for fitting only)."""
    if len(raw) <= most:
        return raw
    at = np.linspace(0, len(raw) - piece, max(1, most // piece)).astype(int)
    return b"".join(raw[a : a + piece] for a in at)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)
