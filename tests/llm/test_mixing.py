import numpy as np
import pytest

from zonecast.llm import mixing


def brute_rake(cells, shares):
    """cells: {(s, l, t): tokens}; shares: three dicts."""
    w = {k: float(v) for k, v in cells.items()}
    for _ in range(400):
        for i in range(3):
            have = {}
            for k, v in w.items():
                have[k[i]] = have.get(k[i], 0) + v
            w = {k: v * shares[i][k[i]] / have[k[i]] if have[k[i]] else 0.0 for k, v in w.items()}
    return w


def brute_chance(cells, raked, fraction):
    total = sum(cells.values())
    weight = {k: raked[k] * total / cells[k] for k in cells if cells[k]}
    live = {k: v for k, v in weight.items() if v > 0}
    want = fraction * sum(cells[k] for k in live)
    lo, hi = 0.0, 1e9
    for _ in range(300):
        c = (lo + hi) / 2
        if sum(cells[k] * min(1, c * live[k]) for k in live) < want:
            lo = c
        else:
            hi = c
    return {k: min(1, hi * weight[k]) if weight.get(k) else (fraction if not cells[k] else 0.0) for k in cells}


def corpus(spark, n=4000):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        s = "big" if rng.random() < 0.4 else f"s{rng.integers(0, 4)}"
        lang = str(rng.choice(["en", "de", "fr"], p=[0.7, 0.2, 0.1]))
        text = "word " * int(rng.integers(1, 40)) + ("all rights reserved" if rng.random() < 0.2 else "") + (" a | b" if rng.random() < 0.1 else "")
        rows.append((i, text, lang, s, 1))
    rows += [(None, "no id here", None, None, 1), (9001, None, "en", "big", 1), (9002, "", "xx", "big", 1), (9003, "word " * 50_000, "en", None, 1), (5, rows[5][1], rows[5][2], rows[5][3], 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, chance int")


@pytest.mark.parametrize("targets", [None, {"lang": {"en": 0.3, "de": 0.3}, "source": {"big": 0.2, "nowhere": 0.1}}])
def test_weights_equal_brute_force(spark, targets):
    docs = corpus(spark)
    got = mixing.mix(docs, targets, fraction=0.4).collect()
    assert len(got) == docs.count()
    cells, given = {}, targets if targets is not None else {"lang": mixing.LANG_SHARES, "topic": mixing.TOPIC_SHARES}
    for r in got:
        cells[r.source, r.lang, r.topic] = cells.get((r.source, r.lang, r.topic), 0) + r.tokens
    shares = []
    for i, name in enumerate(mixing.MARGINS):
        sums = {}
        for k, v in cells.items():
            sums[k[i]] = sums.get(k[i], 0) + v
        sums = {k: v for k, v in sums.items() if v}
        if given.get(name):
            free = sum(v for k, v in sums.items() if k not in given[name])
            left = max(0.0, 1 - sum(given[name].values()))
            w = {k: given[name][k] if k in given[name] else left * v / free for k, v in sums.items()}
        else:
            w = {k: v**0.5 for k, v in sums.items()}
        shares.append({k: w.get(k, 0.0) / sum(w.values()) for k in {c[i] for c in cells}})
    raked = brute_rake(cells, shares)
    chance = brute_chance(cells, raked, 0.4)
    for r in got:
        assert r.chance == pytest.approx(chance[r.source, r.lang, r.topic], abs=2e-3)
    expected = sum(r.tokens * r.chance for r in got)
    assert expected == pytest.approx(0.4 * sum(r.tokens for r in got if r.weight > 0), rel=1e-6)


def test_selection_follows_the_chances(spark):
    docs = corpus(spark).where("doc_id < 4000")
    got = mixing.mix(docs, fraction=0.4).collect()
    assert abs(sum(r.selected for r in got) - sum(r.chance for r in got)) < 5 * len(got) ** 0.5 / 2
    again = {(r.doc_id, r.selected) for r in mixing.mix(docs.repartition(7), fraction=0.4).collect()}
    assert again == {(r.doc_id, r.selected) for r in got}
    kept = mixing.sample(docs, fraction=0.4)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.selected)


def test_empty_and_tokenless_tables(spark):
    docs = corpus(spark, 10)
    assert mixing.mix(docs.limit(0)).count() == 0
    blank = docs.where("doc_id in (9001, 9002)")
    assert {r.chance for r in mixing.mix(blank, fraction=0.4).collect()} == {0.4}
    assert mixing.sample(docs.limit(0)).count() == 0


def test_tokens_count_words(spark):
    docs = spark.createDataFrame([(1, " a\tb\n c  ", "x", "y"), (2, "", "x", "y"), (3, None, "x", "y"), (4, "é ñ", "x", "y")], "doc_id long, text string, lang string, source string")
    assert {r.doc_id: r.tokens for r in mixing.described(docs).collect()} == {1: 3, 2: 0, 3: 0, 4: 2}


def test_languages_without_a_target_are_sampled(spark):
    docs = corpus(spark).where("doc_id < 4000").selectExpr("doc_id", "text", "case when doc_id % 20 = 0 then null when doc_id % 20 = 1 then 'xx' when doc_id % 20 = 2 then 'EN' else lang end as lang", "source", "chance")
    got = mixing.mix(docs, fraction=0.4).collect()
    total, of = 0.0, {}
    for r in got:
        assert r.weight > 0 and r.chance > 0
        total += r.tokens * r.weight
        of[r.lang] = of.get(r.lang, 0.0) + r.tokens * r.weight
    # the table has no Spanish, whose share falls to the others in proportion
    assert sum(of[v] for v in (None, "xx", "EN")) / total == pytest.approx(mixing.UNTARGETED / (1 - mixing.LANG_SHARES["es"]), rel=1e-3)
    picked = {r.lang for r in got if r.selected}
    assert {None, "xx", "EN"} <= picked
    assert {r.doc_id for r in mixing.sample(docs, fraction=0.4).collect()} == {r.doc_id for r in got if r.selected}


def test_targets_that_leave_nothing_raise(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "s"), (2, "c d e", None, "s"), (3, "f", "xx", "s")], "doc_id long, text string, lang string, source string")
    with pytest.raises(ValueError, match=r"lang.*None \(1 documents, 3 tokens\), 'xx'"):
        mixing.mix(docs, {"lang": {"en": 0.7, "de": 0.3}})
    assert mixing.mix(docs.where("lang = 'en'"), {"lang": {"en": 0.7, "de": 0.3}}).count() == 1


def test_columns_with_clashing_names(spark):
    docs = spark.createDataFrame([(i, f"text {i}", "en", f"s{i % 3}", 5) for i in range(200)], "doc_id long, text string, lang string, source string, n_chars long")
    plain = {r.doc_id for r in mixing.sample(docs).collect()}
    for c in ("_mix_chance", "_mix_weight", "_mix_source", "_own_source", "_row", "topic", "chance", "weight", "tokens", "a b.c"):
        docs = docs.withColumn(c, mixing.F.lit(0.5))
    got = mixing.sample(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    assert {r.doc_id for r in rows} == plain and all(set(r[5:]) == {0.5} for r in rows) and 0 < len(plain) < 200


def test_factors_equal_the_single_partition(spark, monkeypatch):
    """Cell tables beyond the bound are raked by factors per margin: the same weights and chances."""
    rng = __import__("random").Random(3)
    cells = [(f"s{i % 40}" if i % 9 else None, rng.choice(["en", "de", "xx", None]), rng.choice(["prose", "legal", "table"]), rng.choice([0, 5, 100, 4000])) for i in range(400)]
    df = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long").groupBy("source", "lang", "topic").agg(mixing.F.sum("tokens").alias("tokens")).cache()
    given = {"lang": mixing.LANG_SHARES, "topic": mixing.TOPIC_SHARES}
    key = lambda r: (r.source, r.lang, r.topic)
    one = mixing.settled(mixing.rake(mixing.with_shares(df, given, 0.5), most=2, rounds_at_once=2), "raked")
    monkeypatch.setattr(mixing, "BROADCAST_CELLS", 10)  # some margins are shuffled
    many = mixing.rake_by_factors(df, mixing.margin_shares(df, given, 0.5), tolerance=0, most=2)
    a, b = ({key(r): r.raked for r in t.collect()} for t in (one, many))
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-12 for k in a)
    for fraction in (0.2, 0.95):
        a, b = ({key(r): (r.weight, r.chance) for r in f(one, fraction).collect()} for f in (mixing.chances, mixing.chances_by_levels))
        for k, (w, c) in a.items():
            assert (w is None) == (b[k][0] is None) and abs((w or 0) - (b[k][0] or 0)) < 1e-9 and abs(c - b[k][1]) < 1e-9
