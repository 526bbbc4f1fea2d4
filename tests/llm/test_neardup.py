import itertools
import random
import re

import pytest

from zonecast.llm import neardup
from zonecast.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_set(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def brute(rows, k, percent=80):
    sets = {d: brute_set(t, k) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    seen = {}
    order = {}
    for s in sets.values():
        for g in s:
            order[g] = order.get(g, 0) + 1
    for d, s in sets.items():
        first = sorted(s, key=lambda g: (order[g], g))[: len(s) - -(-percent * len(s) // 100) + 1]
        for e in {e for g in first for e in seen.get(g, ())}:
            o = len(s & sets[e])
            if 100 * o >= percent * (len(s) + len(sets[e]) - o):
                a, b = find(d), find(e)
                parent[max(a, b)] = min(a, b)
        for g in first:
            seen.setdefault(g, []).append(d)
    return sorted((d, len(sets[d]), find(d), find(d) == d) for d in sets)


def report(spark, rows, k=4, extra=False):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    if extra:
        docs = docs.selectExpr("*", "1 as n", "'x' as set_key", "2 as x", "3 as rep")
    return sorted(tuple(r) for r in neardup.near_duplicate_report(docs, k).collect())


def test_shingle_sets_equal_words():
    texts = ["The cat  sat\ton\n the MAT", "the CAT sat on the mat", "a b c", "a b c d", "", "   ", "é É a b c d\x0b e\x1cf", "x y z x y z x y z"]
    got = neardup.shingle_sets([t.encode() for t in texts], 4)
    for (i, a), (j, b) in itertools.combinations(enumerate(texts), 2):
        x, y = brute_set(a, 4), brute_set(b, 4)
        assert len(got[i]) == len(x)
        assert len(set(got[i].tolist()) & set(got[j].tolist())) == len(x & y)


def perturbed(rng, words, rate):
    return [rng.choice(["zeta", "kappa", "omega"]) + str(rng.randrange(10**6)) if rng.random() < rate else w for w in words]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_groups_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    passage = [word() for _ in range(60)]
    rows, n = [], 0
    for g in range(12):
        base = [word() for _ in range(rng.choice([3, 6, 20, 30, 40, 120, 400]))]
        for _ in range(rng.choice([1, 2, 12])):
            out = perturbed(rng, base, rng.choice([0, 0.005, 0.02, 0.03, 0.05, 0.06]))
            cut = rng.choice([0, 0, 0, 1, 2, len(base) // 9])
            rows.append((n * 3 % 997, " ".join(out[cut:])))
            n += 1
        rows.append((n * 3 % 997, " ".join(passage + base[:40])))
        n += 1
    rows += [(2000, None), (2001, ""), (2002, " \n "), (2003, "Two Words"), (2004, "two  words"), (2005, "word " * 30000), (2006, "word " * 400)]
    assert report(spark, rows, 4, extra=seed == 1) == brute(rows, 4)


def test_members_of_one_hub_that_it_does_not_join(spark):
    """Deletions chain: ends are near their neighbours but not near the hub."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(base[: 300 - 18 * i])) for i in range(10)]
    rows += [(50 + i, " ".join(perturbed(rng, base, 0.05))) for i in range(40)]
    twin = perturbed(rng, base, 0.12)
    rows += [(200, " ".join(twin)), (201, " ".join([*twin[:-2], "other", "end"]))]
    assert report(spark, rows) == brute(rows, 4)


def test_edges_of_the_table(spark):
    assert report(spark, []) == []
    docs = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (7, "other text is here now"), (8, "a b c d e f")], "doc_id long, text string")
    got = sorted((tuple(r) for r in neardup.near_duplicate_report(docs, 4).collect()), key=str)
    assert got == sorted([(None, 3, None, True)] * 2 + [(7, 3, 7, True)] * 2 + [(7, 2, 7, True), (8, 3, 7, False)], key=str)
    assert sorted(str(r.doc_id) for r in neardup.keep_one(docs, 4).collect()) == ["7", "7", "None", "None"]


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 102), (102, 101), (5, 5)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert all(got[i] == 0 for i in range(61)) and {got[i] for i in (100, 101, 102)} == {100}
    assert components(links.limit(0)).count() == 0


@pytest.mark.parametrize("folder", ["sf0.01"])
def test_query_equals_brute_force(spark, folder):
    docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet").select("doc_id", "text")
    got = sorted(tuple(r) for r in neardup.near_duplicate_report(docs, 4).collect())
    assert got == brute([tuple(r) for r in docs.collect()], 4)


def test_estimate_drops_only_what_is_clearly_below(spark):
    def sketch(shared, own):  # the union's 32 smallest: the shared hashes and half of the own ones of each
        return sorted([*range(1, shared + 1), *own])

    for shared, stays in ((10, False), (11, True), (14, True)):
        rest = 32 - shared
        x, y = [100 + 2 * i for i in range(rest)], [101 + 2 * i for i in range(rest)]
        reps = spark.createDataFrame([(1, sketch(shared, x)), (2, sketch(shared, y))], "rep long, sketch array<bigint>")
        assert neardup._estimated(spark.createDataFrame([(1, 2)], "x long, y long"), reps, 80).count() == stays


def test_each_text_of_a_repeated_id_is_linked(spark):
    rng = random.Random(11)
    for sizes in ((60, 200), (150, 150)):
        texts = [[f"{name}{i}" for i in range(n)] for name, n in zip("st", sizes, strict=True)]
        near = [[*t[:-3], "its", "own", f"end{len(t)}"] for t in texts]
        rows = [(5, " ".join(t)) for t in texts] + [(20 + i, " ".join(t)) for i, t in enumerate(near)]
        rows += [(40 + i, " ".join(perturbed(rng, texts[1], 0.9))) for i in range(4)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = sorted((r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicate_report(docs, 4).collect())
        assert got == [(5, 5, True), (5, 5, True), (20, 5, False), (21, 5, False), *((40 + i, 40 + i, True) for i in range(4))]
        assert not {20, 21} & {r.doc_id for r in neardup.keep_one(docs, 4).collect()}
