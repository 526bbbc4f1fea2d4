import re
from collections import Counter
from itertools import permutations

import pytest

from zonecast.llm import filteraudit

LONG = " ".join(f"w{i}" for i in range(60))


def brute(docs, labels):
    first, marks = {}, {}
    for i, t, *_ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    for i, q, x in labels:
        if i is not None:
            g, b = marks.get(i, (0, 0))
            marks[i] = (max(g, int(q == 1)), max(b, int(x == 1)))
    parts = {}
    for i, t, source in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > first[t]}
        parts.setdefault(source or "", []).append((frozenset(k for k, v in f.items() if v), *marks.get(i, (0, 0))))
    out = set()
    for part, rows in parts.items():
        found, total = {}, Counter()
        for o in permutations("ABCDE"):
            left = rows
            for s, c in enumerate(o, 1):
                here = [r for r in left if c in r[0]]
                left = [r for r in left if c not in r[0]]
                fails = sum(c in r[0] for r in rows)
                found["".join(o), s] = (len(left), len(here), fails - len(here), sum(r[0] == {c} for r in rows), sum(r[1] for r in here), sum(r[2] for r in here))
                total[c] += len(here)
        out |= {(part, o, s, *v, total[o[s - 1]]) for (o, s), v in found.items()}
    return out


COLS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def run(spark, docs, labels, extra=False):
    d = spark.createDataFrame(docs, "doc_id long, text string, source string")
    if extra:  # names that the operator uses itself
        for c in ("part", "words", "mask", "n", "sha", "rank", "quality", "late"):
            d = d.selectExpr("*", f"'x' as {c}")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = filteraudit.filter_audit(d, lab).select(*COLS).collect()
    assert len(rows) == len({(r.part, r.filter_order, r.step) for r in rows})
    return {tuple(r) for r in rows}


def test_edge_rows_equal_brute_force(spark):
    docs = [(5, LONG, "a"), (3, LONG, "b"), (3, LONG, "b"), (9, LONG, None), (None, LONG, "a"), (1, None, "a"), (2, "", ""), (2, "x $5", "a"),
            (7, "A B C " * 40, "a"), (8, "same\twords\x0bhere and " * 30, "c"), (10, LONG + " |", "c"), (11, "É" * 9, "c"), (12, ("Very " * 200_000) + "end", "c")]
    labels = [(5, 1, 0), (5, 0, 1), (3, 1, 1), (2, None, 1), (None, 1, 1), (12, 1, None), (99, 1, 1)]
    want = brute(docs, labels)
    assert run(spark, docs, labels) == want
    assert run(spark, docs, labels, extra=True) == want


def test_random_masks_equal_brute_force(spark):
    import random
    rng = random.Random(5)
    pool = [LONG, LONG + " #", "Short TEXT", "word " * 80, "word " * 80 + "%", "A " * 60 + "&", " ".join(f"Q{i}" for i in range(70)), "b"]
    docs = [(rng.randrange(150), rng.choice(pool), rng.choice(["hot", "hot", "x", None])) for _ in range(300)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 150, 2)]
    assert run(spark, docs, labels) == brute(docs, labels)


def test_empty_tables(spark):
    assert run(spark, [], [(1, 1, 1)]) == set()
    assert run(spark, [(1, "a", "s")], []) == brute([(1, "a", "s")], [])


def test_intervals_cover_each_order_once():
    for mask in range(1, 32):
        hits = [0] * filteraudit.ORDERS
        for m, _, low, high in filteraudit.removal_intervals():
            if m == mask:
                for r in range(low, high):
                    hits[r] += 1
        assert hits == [1] * filteraudit.ORDERS
    ranks = [filteraudit.rank_of("".join(o)) for o in permutations("ABCDE")]
    assert ranks == list(range(filteraudit.ORDERS))


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_sql(spark, sf):
    from tests.oracle_compare import compare, duck
    d = f"/root/testdata/{sf}"
    fn = lambda s, p: filteraudit.filter_audit(s.read.parquet(f"{p}/documents.parquet"), s.read.parquet(f"{p}/labels.parquet"))
    problems, _ = compare(spark, duck(d), "op11", fn, filteraudit.ORACLE, d)
    assert not problems
