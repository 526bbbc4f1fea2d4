"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

``count_above`` factors ``A - t I = L D Lᵀ`` (symmetric pivoting, blocks of one or two): by
Sylvester's law the signs in D say how many eigenvalues lie above t.  Halving by these counts
isolates the k-th largest eigenvalue; Rayleigh quotient iteration then converges cubically inside
its interval, and the counts on both sides of the result certify that it is the k-th.

The matrix is small (dimension of the vectors); one count costs d³/3 multiplications.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
_ALPHA = (1 + 17**0.5) / 8


def count_above(a: np.ndarray, t: float) -> int:
    """How many eigenvalues of ``a`` are greater than ``t``."""
    m = a - t * np.eye(len(a))
    above, k, n = 0, 0, len(m)
    while k < n:
        two, at = False, k
        own = abs(m[k, k])
        if k + 1 < n:
            r = k + 1 + int(np.argmax(np.abs(m[k + 1 :, k])))
            off = abs(m[r, k])
            if own < _ALPHA * off:
                row = np.abs(m[r, k:]).copy()
                row[r - k] = 0
                most = row.max()
                if own * most < _ALPHA * off * off:
                    at, two = r, abs(m[r, r]) < _ALPHA * most
        to = k + two
        if at != to:
            m[[to, at]] = m[[at, to]]
            m[:, [to, at]] = m[:, [at, to]]
        if two:
            block, side = m[k : k + 2, k : k + 2].copy(), m[k + 2 :, k : k + 2]
            above += 1 if np.linalg.det(block) < 0 else 2 * int(block[0, 0] > 0)
            m[k + 2 :, k + 2 :] -= side @ np.linalg.solve(block, side.T)
            k += 2
        else:
            d, side = m[k, k], m[k + 1 :, k]
            above += int(d > 0)
            if d:
                m[k + 1 :, k + 1 :] -= np.outer(side, side / d)
            k += 1
    return above


def _improved(a: np.ndarray, shift: float, q: np.ndarray, apart: np.ndarray, scale: float) -> np.ndarray:
    """One step of inverse iteration, kept orthogonal to the vectors found (rows of ``apart``)."""
    for nudge in (0.0, EPS * scale, 64 * EPS * scale):
        try:
            y = np.linalg.solve(a - (shift + nudge) * np.eye(len(a)), q)
        except np.linalg.LinAlgError:
            continue
        size = np.linalg.norm(y)
        if np.isfinite(size) and size > 0:
            y /= size
            for _ in range(2):
                y = y - apart.T @ (apart @ y)
            return y / max(np.linalg.norm(y), np.finfo(float).tiny)
    return q


def leading(a: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues (falling) and their unit eigenvectors (columns).

    Values that halving cannot separate (equal to rounding) get orthonormal vectors of their common space.
    """
    n = len(a)
    a = (a + a.T) / 2
    scale = float(np.abs(a).sum(axis=1).max()) if n else 0.0  # no eigenvalue is larger in size
    if not scale:  # the zero matrix
        return np.zeros(min(most, n)), np.eye(n)[:, : min(most, n)]
    known = {-1.01 * scale - 1e-300: n, 1.01 * scale + 1e-300: 0}  # point: eigenvalues above it

    def above(t: float) -> int:
        if t not in known:
            known[t] = count_above(a, t)
        return known[t]

    values, vectors = [], np.zeros((0, n))
    rng = np.random.default_rng(12)
    for k in range(1, min(most, n) + 1):
        low = max(t for t, c in known.items() if c >= k)
        high = min(t for t, c in known.items() if c < k)
        while True:
            close = high - low <= 8 * EPS * scale  # halving can't separate what is left
            if close or above(low) - above(high) == 1:
                mid = (low + high) / 2
                q = _improved(a, mid, rng.standard_normal(n), vectors, scale)
                q = _improved(a, mid, q, vectors, scale)
                rho, best = mid, (np.inf, mid, q)
                for _ in range(12):
                    rho = float(q @ a @ q)
                    rest = float(np.linalg.norm(a @ q - rho * q))
                    if rest < best[0]:
                        best = (rest, rho, q)
                    elif best[0] <= 64 * EPS * scale:
                        break
                    q = _improved(a, rho, q, vectors, scale)
                rest, rho, q = best
                slack = 2 * rest + 16 * n * EPS * scale
                inside = low - slack <= rho <= high + slack and rest <= 1e3 * n * EPS * scale
                if close or (inside and above(rho - slack) >= k > above(rho + slack)):
                    break
            mid = (low + high) / 2
            if above(mid) >= k:
                low = mid
            else:
                high = mid
        values.append(rho)
        vectors = np.vstack([vectors, q * np.sign(q[np.argmax(np.abs(q))])])
    by = np.argsort(-np.array(values), kind="stable")  # equal to rounding: their order may differ by it
    return np.array(values)[by], vectors[by].T
