import numpy as np
import pytest

from zonecast.llm import vecdup
from zonecast.llm.flatgraph import ALPHA, FlatGraph, ball

SF = "/root/testdata/sf0.01"


def brute(rows, cosine=0.9):
    ok = {i for i, (_, v) in enumerate(rows) if v and all(c is not None and np.isfinite(c) for c in v) and any(v) and rows[i][0] is not None}
    unit = {i: np.array(rows[i][1], float) / np.linalg.norm(np.array(rows[i][1], float) / max(map(abs, rows[i][1]))) / max(map(abs, rows[i][1])) for i in ok}
    links = {i: set() for i in range(len(rows))}
    for d in {len(u) for u in unit.values()}:
        at = [i for i in ok if len(unit[i]) == d]
        u = np.array([unit[i] for i in at])
        for a, b in zip(*np.nonzero(u @ u.T >= cosine)):
            if a != b:
                links[at[a]].add(at[b])
    comp = {}
    for i in range(len(rows)):
        if i in comp:
            continue
        group, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - group:
                group.add(j)
                todo.append(j)
        for j in group:
            comp[j] = min((rows[k][0] for k in group), default=None) if i in ok else rows[j][0]
    return sorted(((r[0], len(links[i]), comp[i], r[0] is None or r[0] == comp[i]) for i, r in enumerate(rows)), key=str)


def result(spark, rows, typ="float", **kw):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{typ}>")
    for c in ("key", "unit", "cid", "shard", "size", "n_links"):
        df = df.selectExpr("*", f"'z' as {c}")
    return [tuple(r) for r in vecdup.near_vectors(df, **kw).collect()]


def near(rng, base, spread):
    return [float(x) for x in np.float32(np.array(base) + spread * rng.standard_normal(len(base)) * np.linalg.norm(base) / len(base) ** 0.5)]


def rows_of(rng, n, d, groups):
    rows = [(i, [float(x) for x in np.float32(rng.standard_normal(d))]) for i in range(n)]
    k = n
    for size, spread in groups:
        base = rng.standard_normal(d)
        for _ in range(size):
            rows.append((k, near(rng, base, spread)))
            k += 1
    return rows


def test_edge_rows(spark):
    inf, nan = float("inf"), float("nan")
    a, b = [1.0, 2.0, 3.0], [2.0, -1.0, 0.5]
    rows = [(5, a), (4, [2.0, 4.0, 6.0]), (3, [-1.0, -2.0, -3.0]), (9, None), (10, []), (11, [0.0] * 3), (12, [1.0, None, 3.0]), (13, [nan, 1.0, 1.0]), (14, [inf, 1.0, 1.0]),
            (None, a), (20, b), (20, b), (21, [0.0, -0.0, 1.0]), (22, [-0.0, 0.0, 1.0]), (23, [1.0, 2.0]), (24, [1.0, 2.0, 3.0, 0.0]), (30, a), (30, [1e30, 2e30, 3e30]), (31, [1e-30, 2e-30, 3e-30])]
    got = result(spark, rows)
    assert sorted([r[:4] for r in got], key=str) == brute(rows)
    assert {r[4] for r in got} == {1.0}
    assert result(spark, []) == [] and result(spark, [(1, None)])[0][:4] == (1, 0, 1, True)


def test_whole_table_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted([r[:4] for r in result(spark, rows)], key=str) == brute(rows)


def test_many_shards_and_a_hot_group(spark, monkeypatch):
    """Shards of 64 and of several levels; a third of the rows are near copies, a sixth are equal."""
    monkeypatch.setattr(vecdup, "SHARD", 96)
    monkeypatch.setattr(vecdup, "FANOUT", 16)
    monkeypatch.setattr(vecdup, "SALT_ROWS", 200)
    rng = np.random.default_rng(4)
    rows = rows_of(rng, 700, 24, [(500, 0.2), (30, 0.3), *[(2, 0.25)] * 60])
    rows += [(5000 + i, rows[3][1]) for i in range(300)]
    want = brute(rows)
    got = sorted([r[:4] for r in result(spark, rows)], key=str)
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    by = {r[0]: r[1] for r in want}
    assert all(r[1] <= by[r[0]] for r in got)  # no link below the threshold
    assert found >= 0.99 * there
    comp = {r[0]: r[2] for r in want}
    assert sum(r[2] == comp[r[0]] for r in got) >= 0.99 * len(got)


def test_audit_counts_like_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = rows_of(rng, 200, 16, [(40, 0.3), *[(2, 0.2)] * 20])
    seen = {}
    real = vecdup.audit
    monkeypatch.setattr(vecdup, "audit", lambda c, li, cos: seen.setdefault("x", real(c, li, cos)))
    result(spark, rows)
    assert seen["x"] == (sum(r[1] for r in brute(rows)),) * 2


@pytest.mark.parametrize("spread", [0.05, 0.3, 0.6, 1.5])
def test_range_search_finds_every_partner_of_a_shard(spread):
    rng = np.random.default_rng(int(spread * 100))
    base = rng.standard_normal((12, 32))
    x = np.concatenate([b + spread * rng.standard_normal((40, 32)) for b in base] + [rng.standard_normal((100, 32))])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    g = FlatGraph(u, 0.9)
    q, at, led = g.within(u, np.arange(len(u)), 0.9)
    a, b = np.nonzero(u @ u.T >= 0.9)
    assert set(zip(q.tolist(), at.tolist())) == set(zip(a.tolist(), b.tolist()))
    assert led.mean() > 0.8  # the way from the medoid alone
    # queries that are no rows of the graph start at the medoid only
    far = np.full(len(u), -1)
    q, at, _ = g.within(u, far, 0.9)
    assert len(q) >= 0.8 * len(a)


def test_pruning_rule():
    """Every candidate within the ball has an edge that is ALPHA times nearer to it, or is one."""
    rng = np.random.default_rng(2)
    x = rng.standard_normal(16) + 0.35 * rng.standard_normal((150, 16))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    g = FlatGraph(u, 0.9)
    dist = np.sqrt(np.maximum(2 - 2 * (u @ u.T), 0))
    for p in range(len(u)):
        out = g.dst[g.start[p] : g.start[p + 1]]
        for c in np.flatnonzero(g.cos[p] >= ball(0.9)):
            if c != p and c not in out:
                assert (ALPHA * dist[out, c] <= dist[p, c] + 1e-9).any()


@pytest.mark.parametrize("m", [0, 1, 2, 3])
def test_small_graphs(m):
    u = np.eye(4)[:m]
    q, at, led = FlatGraph(u, 0.9).within(u, np.arange(m), 0.9)
    assert q.tolist() == at.tolist() == list(range(m)) and led.all()
