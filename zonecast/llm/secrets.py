"""Secret scan: rule matches, and windows of high Shannon entropy.

Rules find assignments to a secret's name (``assign``), cloud access keys
(``access``) and long hexadecimal runs (``hex``).  Beside them every candidate
string (a run of at least ``WINDOW`` letters, digits and ``+/_=-``) is scanned:
it falls into runs of a character class (hexadecimal, or letters and digits of
mixed kind), and a window of ``WINDOW`` characters slides over each run.  The
window's entropy is kept by incremental counts: with S the sum of c*log2(c) over
its characters' counts, H = log2(n) - S/n, and a step changes two counts.  Windows
that reach the class's threshold are merged to one span (``entropy``).

The allow list suppresses such spans: plain words (one letter case, few digits)
and numbers.  Placeholder words, counting and keyboard runs cut a run in pieces:
no window holds a part of one, and what stands beside them is scanned.  Spans
inside a rule's span are not repeated.

Defined cases: null and empty texts have no spans; rows with equal ids are
scanned each; other columns are ignored.  Work is linear in the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty
from .spans import Span, digest, joined

KINDS = ("assign", "access", "hex", "entropy")
WINDOW = 20

# fixed values: the rules
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a run's first match starts where the run does

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
CLASSES = (("hex", re.compile(r"[0-9a-fA-F]{20,}"), 2.9), ("mixed", re.compile(r"[A-Za-z0-9+/_=-]{20,}"), 3.7))

# fixed values: strings that are not secrets
ALLOWED = tuple(
    re.compile(p)
    for p in (
        r"^[a-z]+[-_/=+]*$|^[A-Z]+[-_/=+]*$|^[A-Z][a-z]+[-_/=+]*$",  # one word
        r"^[0-9_/=+-]+$",  # a number, a date, a rule
        r"^(?:[A-Za-z]+[-_/=+]+)+[A-Za-z]*$",  # words joined by signs
    )
)
# fixed values: parts that are not of a secret
PLACEHOLDER = re.compile(r"(?i)example|placeholder|changeme|your[-_]|xxxx|test[-_]?key|dummy|0123456789|123456789|abcdefgh|qwertyui")
SIGNS = "-_/=+"
_CLOG = [0.0, 0.0, *[c * log2(c) for c in range(2, WINDOW + 2)]]


def entropies(s: str, window: int = WINDOW) -> Iterator[float]:
    """The entropy of every window of ``s``, in order, by incremental counts."""
    clog = _CLOG if window == WINDOW else [0.0, 0.0, *[c * log2(c) for c in range(2, window + 2)]]
    counts: dict[str, int] = {}
    total, top = 0.0, log2(window)
    for i, ch in enumerate(s):
        c = counts.get(ch, 0)
        counts[ch] = c + 1
        total += clog[c + 1] - clog[c]
        if i >= window:
            old = s[i - window]
            c = counts[old]
            counts[old] = c - 1
            total += clog[c - 1] - clog[c]
        if i >= window - 1:
            yield top - total / window


def pieces(run: str) -> Iterator[tuple[int, str]]:
    """What a run holds between placeholders, if it takes a window, and where."""
    low = 0
    for m in PLACEHOLDER.finditer(run):
        if m.start() - low >= WINDOW:
            yield low, run[low : m.start()]
        low = m.end()
    if len(run) - low >= WINDOW:
        yield low, run[low:]


def high_entropy(text: str, candidate: re.Pattern = CANDIDATE, allowed: tuple[re.Pattern, ...] = ALLOWED) -> list[Span]:
    out = []
    for m in candidate.finditer(text):
        s = m.group()
        if any(p.search(s) for p in allowed):
            continue
        for _, run, least in CLASSES:
            for r in run.finditer(s):
                for at, part in pieces(r.group()):
                    if any(p.search(part.lstrip(SIGNS)) for p in allowed):
                        continue
                    at += m.start() + r.start()
                    low = high = None
                    for i, h in enumerate(entropies(part)):
                        if h >= least:
                            if low is None:
                                low = i
                            high = i + WINDOW
                        elif low is not None and i >= high:
                            out.append(("entropy", at + low, at + high))
                            low = high = None
                    if low is not None:
                        out.append(("entropy", at + low, at + high))
    return out


def rules(text: str) -> list[Span]:
    out: list[Span] = []
    if ":" in text or "=" in text:  # no assignment goes without one
        out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    return out + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def merged(spans: list[Span], base: list[Span]) -> list[Span]:
    """Overlapping spans as one, without those inside a span of ``base``."""
    out: list[Span] = []
    for k, a, z in sorted(spans, key=lambda s: (s[1], s[2])):
        if out and a < out[-1][2]:
            out[-1] = (k, out[-1][1], max(z, out[-1][2]))
        else:
            out.append((k, a, z))
    return [s for s in out if not any(a <= s[1] and s[2] <= z for _, a, z in base)]


def scan(text: str) -> tuple[list[Span], list[Span]]:
    """Spans of the rules, and the added ones."""
    base = rules(text)
    return base, merged(high_entropy(text), base)


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, kind, start, end, secret: one row a span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                base, more = scan(t)
                rows += [(d, k, a, z, t[a:z]) for k, a, z in [*base, *more]]
            if rows:
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "kind", "start", "end", "secret"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, "doc_id long, kind string, start long, end long, secret string")


def secret_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans: one row a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = {"n_assign": [], "n_access": [], "n_hex": [], "base_sha256": [], "spans": []}
            for t in b.column(1).to_pylist():
                base, more = scan(t)
                for k in KINDS[:3]:
                    out[f"n_{k}"].append(sum(s[0] == k for s in base))
                out["base_sha256"].append(digest(base, KINDS))
                out["spans"].append(joined([*base, *more], KINDS))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(v, pa.int64() if k[0] == "n" else pa.string()) for k, v in out.items()]], names=["doc_id", *out])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
