"""A flat proximity graph over one shard of unit vectors: robust pruning, greedy and range search, in numpy.

Edges: the other vectors in order of distance; one that is nearer to an edge already chosen than
``1 / ALPHA`` of its own distance is pruned.  Within ``reach`` no candidate is left out, so for every x
with d(p, x) <= reach there is an edge of p that is ``ALPHA`` times nearer to x, or x itself is one.
From q such steps lead to every x within r of q, and never leave the ball of radius (1 + 1/ALPHA) r
around q: the range search that expands everything inside that ball finds all of q's partners in the
shard.  Farther edges only serve the greedy search from the medoid, and are few.
"""

from __future__ import annotations

import numpy as np

ALPHA = 1.2
FAR_EDGES, FAR_CANDIDATES = 16, 48


def ball(cosine: float) -> float:
    """The cosine at the border of the ball that a range search for ``cosine`` expands."""
    r2 = 2 - 2 * cosine
    return 1 - r2 * (1 + 1 / ALPHA) ** 2 / 2


def _pruned(order: np.ndarray, keys: np.ndarray, dist: np.ndarray, most: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Robust pruning for many nodes at once: ``order`` (nodes x candidates, nearest first, -1: none)."""
    m, width = order.shape
    alive = order >= 0
    own = np.where(alive, dist[keys[:, None], order], np.inf)
    src, dst = [], []
    rounds = width if most is None else min(most, width)
    for _ in range(rounds):
        some = np.flatnonzero(alive.any(axis=1))
        if not len(some):
            break
        first = alive[some].argmax(axis=1)
        pick = order[some, first]
        src.append(keys[some])
        dst.append(pick)
        gone = ALPHA * dist[pick[:, None], order[some]] <= own[some]
        alive[some] &= ~gone
        alive[some, first] = False
    return (np.concatenate(src), np.concatenate(dst)) if src else (np.zeros(0, np.int64), np.zeros(0, np.int64))


class FlatGraph:
    """The graph of a shard (``unit``: rows of length 1)."""

    def __init__(self, unit: np.ndarray, cosine: float):
        self.unit = unit
        m = len(unit)
        self.cos = np.clip(unit @ unit.T, -1, 1)
        dist = np.sqrt(2 - 2 * self.cos)
        np.fill_diagonal(dist, 0)
        near = self.cos >= ball(cosine)
        np.fill_diagonal(near, False)
        src, dst = [], []
        # near edges: every candidate inside the ball, in blocks of like width
        width = near.sum(axis=1)
        some = np.flatnonzero(width)
        some = some[np.argsort(width[some], kind="stable")]
        step = 64
        for low in range(0, len(some), step):
            keys = some[low : low + step]
            w = int(width[keys].max())
            d = np.where(near[keys], dist[keys], np.inf)
            order = np.argsort(d, axis=1, kind="stable")[:, :w]
            order = np.where(np.take_along_axis(d, order, axis=1) < np.inf, order, -1)
            a, b = _pruned(order, keys, dist, None)
            src += [a, b]  # and back: vectors at no distance choose one of them all
            dst += [b, a]
        # far edges, for the way there
        if m > 1:
            keys = np.arange(m)
            d = np.where(near, np.inf, dist)
            np.fill_diagonal(d, np.inf)
            w = min(FAR_CANDIDATES, m - 1)
            order = np.argpartition(d, w - 1, axis=1)[:, :w]
            key = np.take_along_axis(d, order, axis=1)
            by = np.argsort(key, axis=1, kind="stable")
            order, key = np.take_along_axis(order, by, axis=1), np.take_along_axis(key, by, axis=1)
            a, b = _pruned(np.where(key < np.inf, order, -1), keys, dist, FAR_EDGES)
            src += [a, b]
            dst += [b, a]
        s = np.concatenate(src) if src else np.zeros(0, np.int64)
        t = np.concatenate(dst) if dst else np.zeros(0, np.int64)
        pairs = np.unique(s * m + t)
        self.src, self.dst = pairs // max(m, 1), pairs % max(m, 1)
        self.start = np.searchsorted(self.src, np.arange(m + 1))
        self.medoid = int(np.argmax(unit @ unit.mean(axis=0))) if m else -1

    def _edges_of(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each of ``nodes`` its neighbours: places in ``nodes``, neighbours."""
        low, high = self.start[nodes], self.start[nodes + 1]
        size = high - low
        which = np.repeat(np.arange(len(nodes)), size)
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
        return which, self.dst[at]

    def greedy(self, queries: np.ndarray, beam: int = 4, most: int = 64) -> np.ndarray:
        """For each query the ``beam`` best nodes found from the medoid (-1: none)."""
        cos = queries @ self.unit.T
        n = len(queries)
        best = np.full((n, beam), -1)
        best[:, 0] = self.medoid
        done = np.zeros(cos.shape, bool)
        rows = np.arange(n)
        for _ in range(most):
            open_ = (best[rows] >= 0) & ~done[rows[:, None], best[rows]]
            has = open_.any(axis=1)
            rows = rows[has]
            if not len(rows):
                break
            node = best[rows, open_[has].argmax(axis=1)]
            done[rows, node] = True
            which, to = self._edges_of(node)
            width = int(np.bincount(which, minlength=len(rows)).max()) if len(which) else 0
            grid = np.full((len(rows), beam + width), -1)
            grid[:, :beam] = best[rows]
            first = np.searchsorted(which, np.arange(len(rows)))
            fresh = ~(best[rows][which] == to[:, None]).any(axis=1)
            grid[which, beam + np.arange(len(which)) - first[which]] = np.where(fresh, to, -1)
            key = np.where(grid >= 0, cos[rows[:, None], grid], -np.inf)
            by = np.argsort(-key, axis=1, kind="stable")[:, :beam]
            best[rows] = np.take_along_axis(grid, by, axis=1)
        return best

    def within(self, queries: np.ndarray, own: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Range search: greedy from the medoid, then everything inside the ball is expanded.

        ``own`` is the query's node if it is one of the graph (-1: none), a second start.  Gives
        pairs (query, node) whose cosine is at least ``cosine``, and which queries the medoid's
        search led to their nearest (own) node.
        """
        border = min(ball(cosine), cosine)
        found_q, found_x, led = [], [], []
        step = max(1, (1 << 20) // max(1, len(self.unit)))
        for low in range(0, len(queries), step):
            q, mine = queries[low : low + step], own[low : low + step]
            cos = q @ self.unit.T
            best = self.greedy(q)
            led.append((best == mine[:, None]).any(axis=1) & (mine >= 0))
            seeds = np.column_stack([best, mine])
            at, _ = np.nonzero(seeds >= 0)
            node = seeds[seeds >= 0]
            seen = np.zeros(cos.shape, bool)
            keep = cos[at, node] >= border
            front = np.unique(at[keep] * len(self.unit) + node[keep])
            while len(front):
                at, node = front // len(self.unit), front % len(self.unit)
                seen[at, node] = True
                fresh = []
                for a in range(0, len(front), 1 << 14):
                    which, to = self._edges_of(node[a : a + (1 << 14)])
                    w = at[a : a + (1 << 14)][which]
                    ok = (cos[w, to] >= border) & ~seen[w, to]
                    fresh.append(np.unique(w[ok] * len(self.unit) + to[ok]))
                front = np.unique(np.concatenate(fresh))
            at, node = np.nonzero(seen & (cos >= cosine))
            found_q.append(at + low)
            found_x.append(node)
        cat = lambda parts, t: np.concatenate(parts) if parts else np.zeros(0, t)
        return cat(found_q, np.int64), cat(found_x, np.int64), cat(led, bool)
