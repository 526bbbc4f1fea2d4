"""Spans of text: (kind, start, end) in code points, end exclusive."""

from __future__ import annotations

import hashlib

Span = tuple[str, int, int]


def joined(spans: list[Span], kinds: tuple[str, ...]) -> str:
    """``kind:start:end`` by start, then by the order of ``kinds``, comma-joined."""
    order = {k: i for i, k in enumerate(kinds)}
    return ",".join(f"{k}:{a}:{z}" for k, a, z in sorted(spans, key=lambda s: (s[1], order[s[0]], s[2])))


def digest(spans: list[Span], kinds: tuple[str, ...]) -> str:
    return hashlib.sha256(joined(spans, kinds).encode()).hexdigest()
