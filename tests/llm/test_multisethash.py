import hashlib

import numpy as np
import pytest

from zonecast.llm import multisethash as m

TEXTS = ["One. Two. Three.\nFour five six.\n\nSeven", "Seven\nFour five six.\n\nOne. Two. Three.", "", None, "é" * 9 + "\n日本", "long paragraph. " * 20_000, "x", "One. Two. Three.\nFour five six."]


def brute(rows):
    """rows in descending id order, ties by text, null ids last."""
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    out = []
    for i, (d, t) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        new = t[: len(t) - half] + nxt[:half]
        out.append((d, len(t), hashlib.sha256(new.encode()).hexdigest(), str(m.Fingerprint(t)), str(m.Fingerprint(new))))
    return out


def test_order_does_not_matter_and_edits_are_sums():
    a, b = (m.Fingerprint(t) for t in TEXTS[:2])
    assert str(a) == str(b) != str(m.Fingerprint(TEXTS[7]))
    c = m.Fingerprint(TEXTS[7]).add("").add("Seven")
    assert str(c) == str(a)
    assert str(c.remove("Seven").remove("")) == str(m.Fingerprint(TEXTS[7]))


@pytest.mark.parametrize("buckets", [1, 5, 40])
def test_report_equals_brute_force(spark, buckets):
    rows = [((i * 7) % 31, t) for i, t in enumerate(TEXTS * 3)] + [(None, "no id"), (None, "none"), (7, "tie"), (7, "tie"), (7, "a tie")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as bucket", "2 as tail").repartition(4)
    got = m.fingerprint_report(docs, buckets).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(brute(rows), key=key)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_one_row_and_none(spark):
    docs = spark.createDataFrame([(5, "a b. c d.")], "doc_id long, text string")
    assert [tuple(r)[:5] for r in m.fingerprint_report(docs).collect()] == brute([(5, "a b. c d.")])
    assert m.fingerprint_report(docs.limit(0)).count() == 0
    assert [r.fingerprint for r in m.fingerprints(docs).collect()] == [str(m.Fingerprint("a b. c d."))]


def test_likeness_follows_shared_text():
    rng = np.random.default_rng(1)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 6))
    sent = [" ".join(word() for _ in range(8)) + "." for _ in range(200)]
    full = " ".join(sent[:100])
    for share in (0, 25, 50, 75, 100):
        other = " ".join([*sent[:share], *sent[100 : 200 - share]])
        _, s = m.Hasher().sums([full, other])
        assert abs(m.likeness(s[:1], s[1:])[0] - share / 100) < 0.35
    assert m.likeness(s[:1], s[1:])[0] == 1.0
