import hashlib
import re

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from zonecast.llm import pii


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0


def brute_base(t):
    num = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", m.start(), m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 14 <= len(num(m[0])) <= 19 and luhn(num(m[0]))]
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(num(m[0])) <= 15]
    return out


def brute_joined(spans):
    order = {k: i for i, k in enumerate(pii.KINDS)}
    return ",".join(f"{k}:{a}:{z}" for k, a, z in sorted(spans, key=lambda s: (s[1], order[s[0]])))


@given(st.text(alphabet="a.@-%+0125679 ()é\n", max_size=100))
def test_base_equals_plain_patterns(t):
    assert sorted(pii.base_spans(t)) == sorted(brute_base(t))


@given(st.lists(st.sampled_from(["4111111111111111", "4111 1111 1111 1111", "+1 (555) 010-9999", "1.2.3.4", "999.1.1.1", "1.2.3.4.5.6.7.8", "a@b.c", "a@b@c.d.e", "@", " ", "-", "x.y%z@q-w.example.com", "٣", "+", "."]), max_size=12))
def test_base_equals_plain_patterns_on_pieces(parts):
    t = "".join(parts)
    assert sorted(pii.base_spans(t)) == sorted(brute_base(t))


def test_long_runs_take_linear_time():
    for t in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+1" + " " * 300_000, "1 " * 150_000, "(at)" * 50_000, "A" * 300_000):
        pii.loose_spans(t, pii.base_spans(t))


def test_em_finds_the_reliable_labelers():
    rng = np.random.default_rng(0)
    truth = rng.random(5000) < 0.4
    right = [0.95, 0.9, 0.8, 0.55]
    votes = np.stack([np.where(rng.random(5000) < r, truth, ~truth) * 2 - 1 for r in right], axis=1)
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    post, table, share = pii.fit_votes(patterns, counts.astype(float))
    assert np.mean((post[inverse.ravel()] > 0.5) == truth) > 0.95 and abs(share - 0.4) < 0.05
    good = table[1, :, 2]
    assert good[0] > good[2] > good[3]


TEXTS = [
    "Please call our phone (555) 010-2233 today, or email jane (at) mail.example.com soon.",
    "See version 123-45-6789 of figure 5; the social security ssn 123-45-6788 was lost.",
    "Dear Dr. Anna Smith, account IBAN DE89 3704 0044 0532 0130 00 is fine. x@y.example.com 10.0.0.1",
    "Plain prose without any of it, only words.",
    "",
    None,
    "word " * 50_000 + "+1 (017) 555-7713 and 4111 1111 1111 1111",
]


def test_report(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS * 5)] + [(None, TEXTS[0]), (0, TEXTS[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as kind", "2 as base", "'x' as spans")
    got = pii.pii_report(docs).collect()
    assert len(got) == len(rows)
    text = dict(rows)
    seen = set()
    for r in got:
        t = text[r.doc_id] or ""
        base = brute_base(t)
        assert r.base_sha256 == hashlib.sha256(brute_joined(base).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(b[0] == k for b in base) for k in pii.KINDS[:4])
        spans = [s for s in r.spans.split(",") if s]
        assert {f"{k}:{a}:{z}" for k, a, z in base} <= set(spans)
        seen |= {s.split(":")[0] for s in spans}
        if t == TEXTS[3]:
            assert spans == []
    assert {"phone", "iban", "name", "email", "ip", "card"} <= seen
    assert pii.pii_report(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in pii.pii_report(docs).collect():
        assert r.base_sha256 == hashlib.sha256(brute_joined(brute_base(text[r.doc_id])).encode()).hexdigest()


def test_rare_patterns_are_learnt(spark):
    rows = [(i, f"see part no {222 + i % 2}-222-2222 there, or call ({200 + i % 700}) 010-2233" if i % 10 == 0 else "see part no 222-222-2222 there") for i in range(3000)]
    rows += [(9000 + i, f"her social security ssn {123 + i}-45-67{80 + i} was lost") for i in range(3)]
    found = pii.candidates(spark.createDataFrame(rows, "doc_id long, text string")).cache()
    weights, posterior = pii.learn(found, max_spans=100)
    assert min(p for (kind, _), p in posterior.items() if kind == "ssn") > 0.8 and min(posterior.values()) < 0.2
    for r in found.where("doc_id >= 9000 or doc_id = 20").collect():
        for s in r.loose:
            p = 1 / (1 + np.exp(-weights[[*s.features, pii.FEATURES]].sum()))
            assert (p >= 0.5) == (posterior[s.kind, s.vote] >= 0.5), (s.kind, p)
