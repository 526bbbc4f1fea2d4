import math

import numpy as np
import pytest

from zonecast.llm import spectrum, whitening

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("seed", range(6))
def test_counts_and_pairs_equal_a_dense_solver(seed):
    rng = np.random.default_rng(seed)
    d = [1, 2, 5, 30, 64, 64][seed]
    a = rng.standard_normal((d, d))
    a = a + a.T if seed % 2 else a @ a.T * 1e6
    want, axes = np.linalg.eigh(a)
    for t in rng.uniform(want[0] - 1, want[-1] + 1, 20):
        assert spectrum.count_above(a, t) == int((want > t).sum())
    values, vectors = spectrum.leading(a, 16)
    k = min(16, d)
    assert np.allclose(values, want[::-1][:k], rtol=1e-12, atol=1e-12 * np.abs(want).max())
    assert np.allclose(np.abs((axes[:, ::-1][:, :k] * vectors).sum(axis=0)), 1, atol=1e-9)


@pytest.mark.parametrize("spectrum_", [[5, 5, 5, 2, 2, 1, 0, 0], [1] * 8, [0] * 8, [1, 1 + 1e-13, 1 - 1e-9, 0.5, 0, 0, 0, 0], [1e8, 1, 1e-8, 0, 0, 0, 0, 0]])
def test_equal_and_close_values(spectrum_):
    q, _ = np.linalg.qr(np.random.default_rng(3).standard_normal((8, 8)))
    a = q @ np.diag(np.array(spectrum_, float)) @ q.T
    a = (a + a.T) / 2
    values, vectors = spectrum.leading(a, 8)
    assert np.allclose(values, sorted(spectrum_, reverse=True), atol=1e-13 * max(1, max(spectrum_)))
    assert np.allclose(vectors.T @ vectors, np.eye(8), atol=1e-6)
    assert np.allclose(a @ vectors, vectors * values, atol=1e-12 * max(1, max(spectrum_)))


def brute(rows):
    ok = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for _, v in ok]
    fit = sorted(set(map(tuple, x)))
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    z = np.array([[n * a - b for a, b in zip(r, s)] for r in fit], float) / n
    v = z.T @ z / n
    e, q = np.linalg.eigh(v)
    return ok, x, n, s, e[::-1], q[:, ::-1], np.trace(v)


def check(spark, rows, **extra):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for c in ("x", "v", "n", "i", "component", "rows"):
        df = df.selectExpr("*", f"'y' as {c}")
    got = whitening.whiten(df).collect()
    ok, x, n, s, e, q, trace = brute(rows)
    k = min(16, int((e > 1e-10 * e[0]).sum()))
    assert len(got) == len(ok) * k
    by = {}
    for r in got:
        assert r.n == n and r.identity_error <= 1e-4 and abs(r.explained - e[r.component - 1] / trace) <= 1e-9
        by.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    sign = {}
    for (i, _), one in zip(ok, x):
        dev = sum((n * a - b) ** 2 for a, b in zip(one, s))
        for c in range(1, k + 1):
            want = float((np.array(one) - np.array(s) / n) @ q[:, c - 1]) / math.sqrt(e[c - 1])
            assert all(r.deviation == dev for r in by[i][c])
            if abs(want) > 1e-3:
                sg = sign.setdefault(c, math.copysign(1, want * by[i][c][0].whitened))
                assert abs(by[i][c][0].whitened - sg * want) < 1e-6


def test_edge_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(c) for c in rng.standard_normal(5) * [9, 7, 5, 3, 1]]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(400)]  # a hot vector
    rows += [(2000, None), (2001, [1.0, None, 2.0, 1.0, 1.0]), (2002, [float("nan")] * 5), (2003, [float("inf")] * 5), (2004, [0.0] * 5), (2005, [-0.0] * 5)]
    check(spark, rows)


def test_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(spark, rows)


def test_little_or_nothing(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for rows in ([], [(1, None)], [(1, []), (2, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5):
        got = whitening.whiten(make(rows))
        assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert got.count() == 0
    # the most frequent length counts, null ids are rows, a flat dimension has no component
    got = whitening.whiten(make([(1, [1.0, 5.0]), (None, [2.0, 5.0]), (2, [4.0, 5.0]), (3, [1.0])])).collect()
    assert sorted(str(r.vec_id) for r in got) == ["1", "2", "None"] and {r.component for r in got} == {1}


def test_large_entries_stay_exact(spark):
    rows = [(1, [2.0**40, 0.0]), (2, [-(2.0**40), 3.0]), (3, [2.0**45, 1.0]), (4, [2.0**60, 1.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.vec_id for r in got} == {1, 2, 3} and all(r.deviation is None for r in got)
    assert all(r.identity_error < 1e-4 for r in got)
