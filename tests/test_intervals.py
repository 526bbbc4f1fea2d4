"""Interval joins against theta joins in plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from zonecast.operators import intervals
from zonecast.operators.intervals import interval_join

INF = float("inf")


def meets(a, b, closed, point_a, point_b):
    (x, y), (u, v) = a, b
    if None in (x, y, u, v) or any(c != c for c in (x, y, u, v)) or x > y or u > v:
        return False
    if closed == "both":
        return x <= v and u <= y
    if (not point_a and x == y) or (not point_b and u == v):
        return False
    return (x < v or point_b and x <= v) and (u < y or point_a and u <= y)


def brute(left, right, closed="both", point_l=False, point_r=False):
    return sorted((r[0], s[0]) for r in left for s in right if r[1] is not None and r[1] == s[1] and meets(r[2:4], s[2:4], closed, point_l, point_r))


def spans(rng, n, longest, key, inf=False):
    rows = []
    for i in range(n):
        low = rng.choice([rng.uniform(0, 1000), float(rng.randrange(50))])
        size = rng.choice([0, 1, 5, longest * rng.random(), longest * rng.random() ** 8])
        rows.append((i, key(), low, low + size))
    rows += [(n, "hot", None, 5.0), (n + 1, "hot", 5.0, float("nan")), (n + 2, None, 1.0, 2.0), (n + 3, "hot", 9.0, 3.0)]
    return rows + ([(n + 4, "hot", -INF, INF), (n + 5, "hot", 990.0, INF)] if inf else [])


def frames(spark, *sides):
    return [spark.createDataFrame(s, "id long, k string, low double, high double").repartition(4) for s in sides]


@pytest.mark.parametrize("closed", ["both", "left"])
@pytest.mark.parametrize("longest, inf", [(3, False), (300, True)])
def test_overlaps_equal_a_theta_join(spark, closed, longest, inf):
    rng = random.Random(longest)
    key = lambda: rng.choice(["hot", "hot", "a", "b"])
    left, right = spans(rng, 250, longest, key, inf), spans(rng, 200, 1000, key, inf)
    a, b = frames(spark, left, right)
    got = interval_join(a, b, ["low", "high"], ["low", "high"], ["k"], ["k"], closed=closed)
    assert sorted((r.id, r.right_id) for r in got.collect()) == brute(left, right, closed)


@pytest.mark.parametrize("closed", ["both", "left"])
def test_points_in_intervals_and_unmatched_rows(spark, closed):
    rng = random.Random(8)
    key = lambda: rng.choice(["hot", "a"])
    points, right = [(i, k, a, a) for i, k, a, _ in spans(rng, 200, 1, key)], spans(rng, 60, 40, key)
    a, b = frames(spark, points, right)
    got = interval_join(a.drop("high"), b, "low", ["low", "high"], ["k"], ["k"], closed=closed, how="left").collect()
    want = brute(points, right, closed, point_l=True)
    assert sorted((r.id, r.right_id) for r in got if r.right_id is not None) == want
    assert sorted(r.id for r in got if r.right_id is None) == sorted({p[0] for p in points} - {w[0] for w in want})


def test_points_with_points_times_and_no_key(spark):
    rows = spark.range(40).selectExpr("id", "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, 0, cast(id % 7 as int)) as t", "date'2024-01-01' + cast(id as int) as d")
    got = interval_join(rows, rows, "t", "t")
    assert got.count() == sum(1 for i in range(40) for j in range(40) if i % 7 == j % 7)
    week = rows.selectExpr("id as w", "d as a", "date_add(d, 6) as b")
    got = interval_join(rows, week, "d", ["a", "b"])
    assert sorted((r.id, r.right_w) for r in got.collect()) == [(i, j) for i in range(40) for j in range(40) if j <= i <= j + 6]


def test_without_rows(spark):
    a, b = frames(spark, [(1, "k", 0.0, 1.0)], [])
    assert interval_join(a, b, ["low", "high"], ["low", "high"]).count() == 0
    assert interval_join(a, b, ["low", "high"], ["low", "high"], how="left").count() == 1
    assert interval_join(b, b, ["low", "high"], ["low", "high"]).count() == 0
    with pytest.raises(ValueError):
        interval_join(a, b, "low", "low", closed="right")


def test_no_row_touches_many_buckets_and_no_nested_loop(spark):
    """One interval as long as the axis among very many short ones goes to a coarser level."""
    short = spark.range(20_000).selectExpr("id", "cast(id as double) as low", "id + 0.5 as high")
    long = spark.createDataFrame([(-1, 0.0, 20_000.0)], "id long, low double, high double")
    rows = intervals._prepared(short.unionByName(long), ["low", "high"], [], "_l")
    placed = intervals._placed(rows, 0.0, 20_000.0, 1.0, 3, ("own_l", "first_l", "_l"))
    most = placed.groupBy("_l.id", "level").count().agg(F.max("count")).collect()[0][0]
    assert most <= intervals.SPREAD + 2 and placed.count() < 4 * 3 * 20_001
    got = interval_join(short, short.unionByName(long), ["low", "high"], ["low", "high"])
    assert got.count() == 40_000
    plan = got._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_short_rows_meet_in_fine_buckets_only(spark):
    """Beside long rows, and over an axis of very many widths, the rows compared grow with the pairs."""
    short = spark.range(3000).selectExpr("id", "id * 100.0D as low", "id * 100.0D + 60 as high")
    long = spark.range(5).selectExpr("-id - 1 as id", "id * 1000.0D as low", "id * 1000.0D + 250000 as high")
    rows = short.unionByName(long)
    l, r = (intervals._prepared(rows, ["low", "high"], [], side) for side in ("_l", "_r"))
    a = intervals._placed(l, 0.0, 300_000.0, 60.0, 3, ("own_l", "first_l", "_l")).withColumnsRenamed({"low": "low_l", "high": "high_l"})
    b = intervals._placed(r, 0.0, 300_000.0, 60.0, 3, ("own_r", "first_r", "_r")).withColumnsRenamed({"low": "low_r", "high": "high_r"})
    ends = [(x.low, x.high) for x in rows.collect()]
    want = sum(1 for x, y in ends for u, v in ends if x <= v and u <= y)
    assert interval_join(rows, rows, ["low", "high"], ["low", "high"]).count() == want
    compared = (intervals._met(a, b) if hasattr(intervals, "_met") else a.join(b, ["key", "level", "bucket"])).count()
    assert compared < 5 * want


def test_levels_reach_as_far_as_the_longest_row(spark):
    """Short rows over a long axis need one level; infinite rows need all of them and still match."""
    short = spark.range(2000).selectExpr("id", "id * 1000.0D as low", "id * 1000.0D + 10 as high")
    plan = interval_join(short, short, ["low", "high"], ["low", "high"])
    assert plan.count() == 2000
    ends = spark.createDataFrame([(-1, -INF, INF), (-2, 5.0, INF), (-3, INF, INF)], "id long, low double, high double")
    both = short.unionByName(ends)
    rows = [(r.id, r.low, r.high) for r in both.collect()]
    want = sorted((i, j) for i, x, y in rows for j, u, v in rows if x <= v and u <= y)
    assert sorted((r.id, r.right_id) for r in interval_join(both, both, ["low", "high"], ["low", "high"]).collect()) == want
