"""Personal data by weak supervision.

Candidate spans come from loose patterns.  Labelers vote on each: 1 (personal
data), -1 (not), 0 (no opinion):

* ``form``      regex labelers: the strict form of the kind,
* ``checksum``  digits: Luhn, part and length rules,
* ``gazetteer`` word lists: first names, top-level domains, titles,
* ``context``   words just before the span that go with the kind,
* ``against``   words just before the span that speak against it (version, figure, ...),
* ``boundary``  whether the span stands alone between separators.

Spark counts candidates by kind and vote pattern (at most 3**6 a kind);
expectation-maximisation over these counts estimates how often each labeler is
right on either class, and so a posterior per pattern.  A logistic regression
over hashed features of the span (its shape, neighbouring words, votes) is then
trained on about ``max_spans`` candidates (drawn by a hash, with the share that
their number calls for) towards the posteriors, and decides on every candidate.
Every kind and vote pattern has an equal part of another ``max_spans`` at least:
rare ones are drawn with a larger share, and where they have fewer spans, these
count for as many.

Spans by the four base rules (email, ip, card, phone) always stay; the method
adds spans that the classifier accepts and that overlap no base span.

Texts are read once; candidates with votes and features are written to the
shared folder and read again for the decision.

Defined cases: null and empty texts have no spans; rows with equal ids are
scanned each; without candidates nothing is trained; other columns are ignored.
Work is linear in the text, whatever the text.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled, text_or_empty
from .spans import Span, digest, joined

KINDS = ("email", "ip", "card", "phone", "ssn", "iban", "name")
LABELERS = ("form", "checksum", "gazetteer", "context", "against", "boundary")
FEATURES = 1 << 12

# fixed values: the base rules
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

# fixed values: loose patterns of the method
LOOSE = (
    ("email", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}(?: ?(?:\(dot\)|\[dot\]|\.) ?[A-Za-z0-9-]{1,63}){1,5}")),
    ("phone", re.compile(r"(?<![0-9A-Za-z.+-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z-])")),
    ("ssn", re.compile(r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])")),
    ("iban", re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])")),
    ("name", re.compile(r"(?<![\w])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\.? [A-Z][a-z]{1,30}(?: [A-Z][a-z]{1,30}){0,2}")),
)

# fixed values: gazetteers
FIRST_NAMES = frozenset("james mary john anna peter maria paul laura thomas sarah michael emma david julia daniel sophie hans marie jean claire carlos lucia juan carmen".split())
TOP_DOMAINS = frozenset("com org net edu gov io de fr es uk eu info example".split())
TITLES = frozenset("mr mrs ms dr prof herr frau mme sr sra".split())
FOR = {
    "email": frozenset("email mail e-mail contact write courriel correo".split()),
    "phone": frozenset("phone call tel telephone mobile fax telefon téléphone teléfono".split()),
    "ssn": frozenset("ssn social security".split()),
    "iban": frozenset("iban account konto compte cuenta".split()),
    "name": frozenset("by from with dear contact author name signed".split()),
}
AGAINST = frozenset("version v fig figure table page isbn issn section chapter no nr item part vol".split())


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost matches, found from each at sign outwards: linear in the text."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        low = at
        while low > done and text[low - 1] in LOCAL:
            low -= 1
        m = DOMAIN.match(text, at) if low < at else None
        if m:
            out.append(("email", low, m.end()))
            done = m.end()
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)
    return out


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _part(s: str) -> bool:
    s = s.lstrip("0")
    return len(s) < 3 or (len(s) == 3 and s <= "255")


def base_spans(text: str) -> list[Span]:
    out = emails(text)
    if not DIGIT.search(text):
        return out
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(_part(p) for p in m.group().split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            d = _digits(m.group())
            if 14 <= len(d) <= 19 and luhn(d):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]
    return out


def loose_spans(text: str, base: list[Span]) -> list[Span]:
    """Candidates beside the base spans: loose forms, leftmost first, none that overlaps a base span or another."""
    found = [s for k, p in LOOSE for s in ((k, m.start(), m.end()) for m in p.finditer(text))] if _worth(text) else []
    taken = sorted((a, z) for _, a, z in base)
    out, starts = [], [a for a, _ in taken]
    for k, a, z in sorted(found, key=lambda s: (s[1], -s[2])):
        i = bisect.bisect_left(starts, z)
        if i and taken[i - 1][1] > a:
            continue
        starts.insert(i, a)
        taken.insert(i, (a, z))
        out.append((k, a, z))
    return out


_TITLE = re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\b")


def _worth(text: str) -> bool:
    return bool(DIGIT.search(text)) or "(at)" in text or "[at]" in text or bool(_TITLE.search(text))


def _before(text: str, at: int, n: int = 4) -> list[str]:
    return [w.strip(".,:;()\"'").lower() for w in text[max(0, at - 60) : at].split()[-n:]]


def votes(text: str, span: Span) -> tuple[int, ...]:
    kind, a, z = span
    s, near = text[a:z], _before(text, a)
    d = _digits(s)
    if kind == "email":
        form = 1 if DOMAIN.search(s) else -1 if " " in s and "(" not in s and "[" not in s else 0
        check = 1 if 5 <= len(s) <= 100 else -1
        gaz = 1 if re.split(r"[^A-Za-z0-9]+", s.lower())[-1] in TOP_DOMAINS else -1
    elif kind == "ip":
        form, check, gaz = 1, 1 if all(_part(p) for p in s.split(".")) else -1, 0
    elif kind == "card":
        form, check, gaz = 1 if len(d) in (15, 16) else 0, 1 if luhn(d) else -1, 1 if d[0] in "3456" else 0
    elif kind == "phone":
        form = 1 if s[0] == "+" or s[0] == "(" else 0
        check = 1 if 10 <= len(d) <= 15 and len(set(d)) > 3 else -1
        gaz = 0
    elif kind == "ssn":
        form, check, gaz = 1, 1 if d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000" else -1, 0
    elif kind == "iban":
        t = re.sub(r" ", "", s)
        turned = "".join(str(int(c, 36)) for c in t[4:] + t[:4])
        form, check, gaz = 1, 1 if int(turned) % 97 == 1 else -1, 0
    else:
        words = s.replace(".", "").lower().split()
        form, check, gaz = 1 if len(words) > 2 else 0, 0, 1 if words[0] in TITLES and any(w in FIRST_NAMES for w in words) else 0
    context = 1 if any(w in FOR.get(kind, ()) for w in near) else 0
    against = -1 if any(w in AGAINST for w in near[-2:]) else 0
    left, right = text[a - 1 : a], text[z : z + 1]
    boundary = -1 if left.isalnum() or right.isalnum() else 1
    return form, check, gaz, context, against, boundary


def features(text: str, span: Span, vote: tuple[int, ...]) -> list[int]:
    """Hashed features of a span."""
    kind, a, z = span
    shape = re.sub(r"(.)\1+", r"\1", re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"[0-9]", "9", text[a:z][:80]))))
    names = [f"k={kind}", f"s={kind}{shape}", f"n={kind}{min(z - a, 40) // 4}", *[f"v={kind}{i}{v}" for i, v in enumerate(vote)], *[f"b={kind}{w}" for w in _before(text, a, 2)]]
    return [zlib.crc32(n.encode("utf-8", "replace")) % FEATURES for n in names]


def fit_votes(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray, float]:
    """EM over vote patterns (n, labelers) in {-1, 0, 1}: posterior of class 1 per pattern; for each class and labeler
    the chances of voting -1, 0, 1; and the class's share.  Starts from the majority vote."""
    post = np.clip(0.5 + 0.2 * patterns.sum(axis=1), 0.05, 0.95)
    one_hot = (patterns[:, :, None] == np.array([-1, 0, 1])).astype(np.float64)
    for _ in range(rounds):
        w = np.stack([(1 - post) * counts, post * counts])  # (2, n)
        share = (w[1].sum() + 1) / (w.sum() + 2)
        # a little prior mass keeps labelers better than chance
        prior = np.array([[2.0, 1.0, 1.0], [1.0, 1.0, 2.0]])[:, None, :]
        table = np.einsum("cn,nlv->clv", w, one_hot) + prior
        table /= table.sum(axis=2, keepdims=True)
        score = np.einsum("nlv,clv->cn", one_hot, np.log(table))
        z = score[1] - score[0] + np.log(share / (1 - share))
        new = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        if np.abs(new - post).max() < 1e-9:
            post = new
            break
        post = new
    return post, table, share


def fit_spans(rows: list[list[int]], target: np.ndarray, weight: np.ndarray | None = None, epochs: int = 200, rate: float = 0.5, decay: float = 1e-3) -> np.ndarray:
    """Logistic regression on hashed features towards soft targets, by full-batch AdaGrad.  ``weight``: of each row, 1 if not given."""
    weight = np.ones(len(rows)) if weight is None else weight
    w, square = np.zeros(FEATURES + 1), np.full(FEATURES + 1, 1e-6)
    flat = np.concatenate([[*r, FEATURES] for r in rows]).astype(np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) + 1 for r in rows])
    for _ in range(epochs):
        p = 1 / (1 + np.exp(-np.bincount(owner, w[flat], len(rows))))
        g = np.bincount(flat, (weight * (p - target))[owner], FEATURES + 1) / weight.sum() + decay * w
        square += g * g
        w -= rate * g / np.sqrt(square)
    return w


SPAN = "array<struct<kind:string,start:int,stop:int,vote:int,features:array<int>>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("vote", pa.int32()), ("features", pa.list_(pa.int32()))]))


def _packed(vote: tuple[int, ...]) -> int:
    out = 0
    for v in vote:
        out = out * 3 + v + 1
    return out


def _unpacked(code: int) -> list[int]:
    out = []
    for _ in LABELERS:
        out.append(code % 3 - 1)
        code //= 3
    return out[::-1]


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, base (spans of the base rules) and loose (the other candidates), each with votes and features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            base, loose = [], []
            for t in b.column(1).to_pylist():
                known = base_spans(t)
                for spans, out in ((known, base), (loose_spans(t, known), loose)):
                    rows = []
                    for s in spans:
                        v = votes(t, s)
                        rows.append({"kind": s[0], "start": s[1], "stop": s[2], "vote": _packed(v), "features": features(t, s, v)})
                    out.append(rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(base, _SPAN_TYPE), pa.array(loose, _SPAN_TYPE)], names=["doc_id", "base", "loose"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, f"doc_id long, base {SPAN}, loose {SPAN}")


def learn(found: DataFrame, max_spans: int = 20_000) -> tuple[np.ndarray | None, dict[tuple[str, int], float]]:
    """Classifier weights and the posterior of each (kind, vote pattern)."""
    each = found.select("doc_id", F.explode(F.concat("base", "loose")).alias("s")).select("doc_id", "s.*")
    counted = each.groupBy("kind", "vote").agg(F.count(F.lit(1)).alias("n")).collect()  # at most kinds * 3**labelers rows
    if not counted:
        return None, {}
    posterior = {}
    for kind in sorted({r.kind for r in counted}):
        mine = sorted((r for r in counted if r.kind == kind), key=lambda r: r.vote)
        post, _, _ = fit_votes(np.array([_unpacked(r.vote) for r in mine]), np.array([r.n for r in mine], np.float64))
        posterior |= {(kind, r.vote): float(p) for r, p in zip(mine, post, strict=True)}
    share, least = min(1.0, max_spans / sum(r.n for r in counted)), max(1, max_spans // len(counted))
    shares = each.sparkSession.createDataFrame([(r.kind, r.vote, min(1.0, max(share, least / r.n))) for r in counted], "kind string, vote int, share double")
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", "start", "kind"), 11).cast("double") / float(1 << 53)
    drawn = each.join(F.broadcast(shares), ["kind", "vote"]).where(draw < F.col("share"))
    sample = sorted(drawn.select("kind", "vote", "features").collect(), key=lambda r: (r.kind, r.vote, r.features))
    few = {(r.kind, r.vote): max(1.0, least / r.n) for r in counted}
    weights = fit_spans([r.features for r in sample], np.array([posterior[r.kind, r.vote] for r in sample]), np.array([few[r.kind, r.vote] for r in sample]))
    return weights, posterior


def decide(found: DataFrame, weights: np.ndarray | None, least: float = 0.5) -> DataFrame:
    """doc_id, n_<kind> of the base kinds, base_sha256, spans (base ones and accepted others)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = {"n_email": [], "n_ip": [], "n_card": [], "n_phone": [], "base_sha256": [], "spans": []}
            for base, loose in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                known = [(s["kind"], s["start"], s["stop"]) for s in base]
                more = [(s["kind"], s["start"], s["stop"]) for s in loose if weights is not None and 1 / (1 + np.exp(-weights[[*s["features"], FEATURES]].sum())) >= least]
                for k in KINDS[:4]:
                    out[f"n_{k}"].append(sum(s[0] == k for s in known))
                out["base_sha256"].append(digest(known, KINDS))
                out["spans"].append(joined([*known, *more], KINDS))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(v, pa.int64() if k[0] == "n" else pa.string()) for k, v in out.items()]], names=["doc_id", *out])

    return found.select("doc_id", "base", "loose").mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def pii_report(docs: DataFrame, max_spans: int = 20_000) -> DataFrame:
    found = settled(candidates(docs), "pii-candidates")
    weights, _ = learn(found, max_spans)
    return decide(found, weights)
