"""As-of joins and frames against plain SQL, with hot keys, ties, nulls and many ranges."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from zonecast.operators import ordered


@pytest.fixture(autouse=True)
def many_ranges(spark):
    """Small inputs too stay in as many ranges as there are shuffle partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(3)
    key = lambda: rng.choice(["hot", "hot", None, *"abcdefgh"])
    left = [(i, key(), rng.choice([None, *range(60)])) for i in range(900)] + [(10_000 + i, "hot", 7) for i in range(300)]
    right = [(i, key(), rng.choice([None, *range(0, 60, 3)]), i * 0.5) for i in range(500)] + [(5000, "only right", 3, 1.0)]
    return (spark.createDataFrame(left, "id long, k string, t int").repartition(7), spark.createDataFrame(right, "rid long, k string, t int, v double").repartition(5))


def expected(left, right, back, equal, tolerance=None):
    rows = [r for r in right.collect() if r.k is not None and r.t is not None]
    out = set()
    for r in left.collect():
        m = None
        if r.k is not None and r.t is not None:
            fits = [x for x in rows if x.k == r.k and ((x.t < r.t if back else x.t > r.t) or (equal and x.t == r.t))]
            m = (max if back else min)(fits, key=lambda x: (x.t, x.rid), default=None)
            if m and tolerance is not None and abs(m.t - r.t) > tolerance:
                m = None
        out.add((r.id, r.k, r.t, *(m or (None,) * 4)))
    return out


@pytest.mark.parametrize("back", [True, False])
@pytest.mark.parametrize("equal", [True, False])
def test_asof_equals_brute_force(spark, sides, back, equal):
    left, right = sides
    got = ordered.asof_join(left, right, "t", "t", ["k"], ["k"], ties=["rid"], direction="backward" if back else "forward", allow_equal=equal)
    assert got.columns == ["id", "k", "t", "right_rid", "right_k", "right_t", "right_v"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == left.count() and set(rows) == expected(left, right, back, equal)


def test_asof_tolerance_inner_and_no_key(spark, sides):
    left, right = sides
    got = ordered.asof_join(left, right, "t", "t", ["k"], ["k"], ties=["rid"], tolerance=F.lit(1), how="inner")
    assert {tuple(r) for r in got.collect()} == {r for r in expected(left, right, True, True, 1) if r[3] is not None}
    got = ordered.asof_join(left, right, "t", "t", ties=["rid"])
    one = {r.id: r.right_rid for r in got.collect()}
    rows = [r for r in right.collect() if r.t is not None]
    for r in left.collect():
        want = max([x for x in rows if r.t is not None and x.t <= r.t], key=lambda x: (x.t, x.rid), default=None)
        assert one[r.id] == (want and want.rid)


def test_asof_without_rows(spark, sides):
    left, right = sides
    assert ordered.asof_join(left.limit(0), right, "t", "t", ["k"], ["k"]).count() == 0
    assert ordered.asof_join(left, right.limit(0), "t", "t", ["k"], ["k"]).where("right_rid is not null").count() == 0
    with pytest.raises(ValueError):
        ordered.asof_join(left, right, "t", "t", direction="sideways")


def test_a_hot_key_falls_into_many_ranges(spark):
    """A third of the rows under one key: no range holds much more than its share, and the result is that of a plain join."""
    rows = spark.range(30_000).selectExpr("id", "if(id % 3 = 0, 'hot', cast(id % 500 as string)) as k", "id * 7919 % 30000 as t")
    right = rows.where("id % 2 = 0").selectExpr("id as rid", "k", "t")
    base = rows.selectExpr("struct(k) as _key", "t", "id")
    sizes = [r[1] for r in ordered._ranged(base, ["t"]).where("_key.k = 'hot'").groupBy("_range").count().collect()]
    assert len(sizes) >= 2 and max(sizes) <= 1.5 * 30_000 / 8
    got = ordered.asof_join(rows, right, "t", "t", ["k"], ["k"]).select("id", "right_rid").toPandas()
    l, r = rows.toPandas(), right.toPandas()  # noqa: E741
    want = duckdb.sql("select l.id, r.rid as right_rid from l asof left join r on l.k = r.k and l.t >= r.t").df()
    a, b = (x.sort_values("id").fillna(-1).astype("int64").values.tolist() for x in (got, want))
    assert a == b


@pytest.mark.parametrize("rows", [1, 2, 5, 400])
def test_rolling_equals_a_window(spark, rows):
    df = spark.range(3000).selectExpr("id", "case when id % 3 = 0 then 'hot' when id % 7 = 0 then null else cast(id % 40 as string) end as k", "id * 7919 % 3001 as t", "cast(id % 5 = 0 as int) as y").repartition(6)
    got = ordered.rolling(df, ["k"], ["t", "id"], rows, {"n": F.count("y"), "s": F.sum("y")}).toPandas()
    d = df.toPandas()  # noqa: F841
    want = duckdb.sql(f"select *, count(y) over w as n, sum(y) over w as s from d window w as (partition by k order by t, id rows between {rows - 1} preceding and current row)").df()
    assert got.columns.tolist() == want.columns.tolist() and len(got) == 3000
    key = lambda x: sorted(map(tuple, x[["id", "n", "s"]].astype("int64").values))
    assert key(got) == key(want)


def test_rolling_over_ranges_shorter_than_the_frame(spark):
    """Every range holds fewer rows than the frame: rows are taken over from several ranges."""
    df = spark.range(64).selectExpr("id", "'one' as k", "id as t")
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    try:
        got = {r.id: (r.n, r.low) for r in ordered.rolling(df, ["k"], ["t"], 15, {"n": F.count("id"), "low": F.min("id")}).collect()}
        near = {r.id: r.right_id for r in ordered.asof_join(df, df.where("id = 3"), "t", "t", ["k"], ["k"]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert got == {i: (min(i + 1, 15), max(0, i - 14)) for i in range(64)}
    assert near == {i: 3 if i >= 3 else None for i in range(64)}


def test_rolling_edges(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id long, k string")
    assert {(r.id, r.n) for r in ordered.rolling(df, ["k"], ["id"], 3, {"n": F.count("id")}).collect()} == {(1, 1), (2, 2)}
    assert ordered.rolling(df.limit(0), ["k"], ["id"], 3, {"n": F.count("id")}).count() == 0
    with pytest.raises(ValueError):
        ordered.rolling(df, [], ["id"], 0, {})
