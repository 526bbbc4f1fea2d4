import numpy as np
import pytest

from zonecast.llm import byteconv, langid, quality


def brute_pooled(net, row):
    out = []
    for w in byteconv.WIDTHS:
        t = net.p[f"t{w}"]
        z = [sum(t[k][row[i + k]] for k in range(w)) for i in range(len(row) - w + 1)]
        out.append(np.max(z, axis=0))
    return np.concatenate(out)


def test_pooled_equals_brute_force():
    net = byteconv.ByteConv(32, 4, 2, seed=3).freeze()
    rows = np.random.default_rng(1).integers(0, 32, (70, 40))
    got = net.pooled(rows)
    for r, g in zip(rows, got, strict=True):
        np.testing.assert_allclose(g, brute_pooled(net, r), rtol=1e-4, atol=1e-5)


@pytest.mark.parametrize("n", [0, 1, 6, 7, 15, 16, 17, 100, 513])
def test_chunks_cover_everything(n):
    x = np.arange(1, n + 1)
    rows = byteconv.chunked(x, 16)
    windows = {tuple(x[i : i + 6]) for i in range(max(0, n - 5))}
    seen = {tuple(r[i : i + 6]) for r in rows for i in range(11)}
    assert windows <= seen and len(rows) >= 1


def brute_repetition(t):
    out = []
    for i in range(len(t)):
        out.append(any(all(i - j - lag >= 0 and t[i - j] == t[i - j - lag] for j in range(quality.RUN)) for lag in range(2, quality.LAGS + 1)))
    return out


def test_symbols_do_not_depend_on_neighbours():
    texts = [b"abc abc abc abc abc abc", b"", b"abc abc abc abc abc abc", b"x", b"no repeats in here, none at all!", b"ab" * 300]
    got = quality.symbols(texts)
    for t, s in zip(texts, got, strict=True):
        assert [v & 255 for v in s.tolist()] == list(t)
        assert [v >= 256 for v in s.tolist()] == brute_repetition(t)


def corpus(spark, n=300):
    good = ["The cat sat on the mat and looked at number %d for a while.", "We walked home past the %d old trees by the river."]
    rows, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        rows.append((i, "BUY!! NOW!! %d!! " % i * 8 if bad else good[i % 2] % i * 3, "en" if i % 2 else "de", "s", 7))
        labels.append((i, int(not bad), 0))
    rows += [(None, None, None, "s", 7), (n + 1, None, "de", "s", 7), (n + 2, "", None, "s", 7), (n + 3, "word " * 60_000, "en", None, 7), (1, good[1] % 1 * 3, "en", "s", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, _quality_score string, score int")
    return docs, spark.createDataFrame([*labels, (5, 1, 0), (None, 1, 0), (6, None, 0)], "doc_id long, quality int, toxic int")


def test_quality_learns_and_covers_edge_rows(spark):
    docs, labels = corpus(spark)
    got = quality.quality_report(docs.drop("score"), labels, max_docs=150, epochs=6).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    truth = {r.doc_id: r.quality for r in labels.where("quality is not null").collect()}
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 30 and np.mean([a == b for a, b in held]) >= 0.95
    kept = quality.keep_good(docs, labels, max_docs=150, epochs=6)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted for r in got)


def test_quality_without_labels_or_rows(spark):
    docs, labels = corpus(spark, 5)
    assert {r.score for r in quality.quality_report(docs.drop("score"), labels.limit(0)).collect()} == {0.5}
    assert quality.quality_report(docs.limit(0).drop("score"), labels).count() == 0


def test_whole_text_counts():
    net = byteconv.ByteConv(512, 8, 2, seed=5).freeze()
    a = b"plain words here " * 4000
    one, two = quality.score_texts(net, [a, a + b"\xff\xfe\xfd!!"])
    assert one != two


def test_language_learns_and_covers_edge_rows(spark):
    words = {"en": "the of and house water green", "fr": "le été où garçon œuvre très", "de": "der größe über straße müde und"}
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(rng.choice(words[lang].split(), 30)), lang) for i, lang in enumerate(["en", "fr", "de"] * 100)]
    rows += [(900, None, "en"), (901, "", "fr"), (902, "123 !! 456", None), (None, "the house of water", None), (903, rows[0][1] * 500, "en"), (0, rows[0][1], "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.language_report(docs, max_docs=120).collect()
    assert len(got) == len(rows)
    und = [r for r in got if r.lang_pred == "und"]
    assert {r.doc_id for r in und} == {900, 901, 902} and all(r.score == 0.0 for r in und)
    truth = {r[0]: r[2] for r in rows}
    held = [r.lang_pred == truth[r.doc_id] for r in got if r.held_out and r.lang_pred != "und"]
    assert len(held) > 40 and np.mean(held) >= 0.95
    assert {r.lang_pred for r in langid.language_report(docs.limit(0)).collect()} == set()
    nolang = docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in langid.language_report(nolang).collect()} == {"und"}


def test_queries_reach_their_held_out_accuracy(spark):
    from zonecast.llm import registry

    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    q = [(r.predicted, r.quality) for r in registry.op6_quality(spark, folder).where("held_out").join(labels, "doc_id").collect()]
    assert len(q) > 50 and np.mean([a == b for a, b in q]) >= 0.95
    lang = [(r.lang_pred, r.lang) for r in registry.op8_language(spark, folder).where("held_out and lang_pred <> 'und'").join(docs, "doc_id").collect()]
    assert len(lang) > 150 and np.mean([a == b for a, b in lang]) >= 0.95


def test_numbers_are_no_letters():
    assert not any(map(langid.has_letter, ["", "½ ² ①", "Ⅷ", "12 _ %", "٣"]))
    assert all(map(langid.has_letter, ["½a", "é", "日", "ª", "1 x"]))


@pytest.mark.parametrize("classes", [2, 4])
def test_gradients_equal_differences(classes):
    """Every kind of weight against a central difference of the loss."""
    rng = np.random.default_rng(classes)
    net = byteconv.ByteConv(20, 3, classes, seed=classes)
    net.p = {k: v.astype(np.float64) + 0.05 * rng.standard_normal(v.shape) for k, v in net.p.items()}
    rows = rng.integers(0, 20, (9, 12))
    starts, labels, decay = np.array([0, 2, 3, 7]), rng.integers(0, classes, 4), 0.1

    def loss():
        pooled, _ = net._forward(rows, starts)
        prob = byteconv.softmax(net.logits(pooled))
        return -np.log(prob[np.arange(4), labels]).mean() + decay / 2 * (net.p["dense"] ** 2).sum()

    grad, step, seen = net.gradients(rows, starts, labels, decay), 1e-6, 0
    for k, g in grad.items():
        for at in np.ndindex(g.shape):
            was = net.p[k][at]
            net.p[k][at] = was + step
            high = loss()
            net.p[k][at] = was - step
            low = loss()
            net.p[k][at] = was
            assert abs((high - low) / (2 * step) - g[at]) < 1e-6, (k, at)
            seen += g[at] != 0
    assert seen > 50


def test_fitting_holds_symbols_narrow():
    """2,500 texts of 64 KB are no more than two bytes a symbol beside the texts."""
    rows = byteconv.chunked(np.zeros(65536, np.uint16), 512)
    assert rows.base is not None and rows.dtype == np.uint16
