"""Cells, cubes, bitmaps and table differences."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from zonecast.operators import cube, diff, distinct, prep
from zonecast.plans.slices import dashboard_panels


@pytest.fixture(scope="module")
def pitches(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["FF", "FF", "SL", "CU", None]), rng.choice(["A B", "C D", None]), rng.choice("LR"), rng.choice("LR"), rng.choice([0, 1, 2, 3, None]), rng.choice([0, 1, 2]),
             rng.choice([rng.randrange(700, 1000) / 8, None, float("nan")]) if i % 9 == 0 else rng.randrange(700, 800) / 8, rng.randrange(-12, 13) / 10, rng.randrange(10, 41) / 10, rng.choice([0, 1])) for i in range(900)]
    return spark.createDataFrame(rows, "pitch_type string, pitcher_name string, stand string, p_throws string, balls int, strikes int, release_speed double, plate_x double, plate_z double, is_strike int")


def rows_of(df):
    return sorted(([round(v, 9) if isinstance(v, float) else v for v in r] for r in df.collect()), key=str)


@pytest.mark.parametrize("types, names, heat, grid", [
    (["FF", "SL"], [], "All", {}), (["FF", "CU"], ["A B"], "FF", {"pitch_type": "SL", "balls": 1}), ([], None, "All", {"stand": "L"}), (["FF"], ["nobody"], "SL", {"balls": 3, "strikes": 2, "pitch_type": "CU", "stand": "L", "p_throws": "R", "pitcher_name": "C D"})])
def test_panels_from_cells_equal_panels_from_rows(pitches, types, names, heat, grid):
    df = pitches.where("release_speed is null or not isnan(release_speed)")
    cells = cube.dashboard_cells(df)
    a = dashboard_panels(df, types, names, heat, grid_value="prob", grid_filters=grid)
    b = dashboard_panels(df, types, names, heat, grid_value="prob", grid_filters=grid, cells=cells)
    assert set(a) == set(b)
    for name in ("filter_options", "shown_vs_total", "overview", "rate_by_pitch_type", "rate_by_count", "heatmap_summary", "zone_grid", "grid_summary"):
        assert a[name].columns == b[name].columns, name
        assert rows_of(a[name]) == rows_of(b[name]), name
        assert all("slice-cells" in f for f in b[name].inputFiles())


def test_cube_and_sets_equal_sql(pitches):
    dims = ["pitch_type", "balls", "stand"]
    d = pitches.toPandas()  # noqa: F841
    d["balls"] = d["balls"].astype("Int64")
    cells = cube.slice_cells(pitches, [*dims, "strikes"])
    body = "count(*) as n_pitches, sum(is_strike) as n_strikes, avg(is_strike) as strike_rate from d"
    want = duckdb.sql(f"select pitch_type, balls, stand, grouping(pitch_type, balls, stand) as slice_id, {body} group by cube (pitch_type, balls, stand)").fetchall()
    fix = lambda rows: sorted(([None if v != v else int(v) if isinstance(v, float) and v == int(v) and i < 4 else round(v, 9) if isinstance(v, float) else v for i, v in enumerate(r)] for r in rows), key=str)
    assert fix(cube.slice_cube(cells, dims).collect()) == fix(want)
    want = duckdb.sql(f"select pitch_type, balls, grouping(pitch_type, balls) as slice_id, {body} group by grouping sets ((pitch_type), (pitch_type, balls), ())").fetchall()
    assert fix(cube.chosen_slices(cells, [["pitch_type"], ["pitch_type", "balls"], []]).collect()) == fix(want)


def test_cells_merge(pitches):
    a, b = pitches.where("strikes = 0"), pitches.where("strikes <> 0")
    dims = ["pitch_type", "strikes"]
    both = cube.merged(cube.slice_cells(a, dims).unionByName(cube.slice_cells(b, dims)), ["pitch_type"])
    assert rows_of(both) == rows_of(cube.slice_cells(pitches, ["pitch_type"]))
    none = cube.slice_cells(pitches.limit(0), dims)
    assert cube.totals(none).collect()[0].n_pitches == 0 and cube.slice_cube(none, dims).where("n_pitches > 0").count() == 0


def test_bitmaps_count_at_every_level(spark):
    rows = spark.range(20_000).selectExpr("case when id % 3 = 0 then 'hot' when id % 50 = 1 then null else cast(id % 7 as string) end as g", "id % 4 as day", "case when id % 11 = 0 then null else id * 37 % 90001 - 500 end as u").unionByName(spark.createDataFrame([(None, 1, 5), ("hot", 1, -2**40), ("hot", 2, 2**40)], "g string, day long, u long"))
    bits = distinct.id_bitmaps(rows, ["g", "day"], "u")
    for dims in (["g", "day"], ["g"], ["day"], []):
        want = rows.groupBy(*dims).agg(F.countDistinct("u").alias("n_distinct"))
        assert rows_of(distinct.distinct_counts(bits, dims)) == rows_of(want)
    parts = [distinct.id_bitmaps(rows.where(f"day = {d}"), ["g"], "u") for d in range(4)]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    assert rows_of(distinct.distinct_counts(whole, ["g"])) == rows_of(distinct.distinct_counts(bits, ["g"]))
    assert distinct.distinct_counts(distinct.id_bitmaps(rows.limit(0), ["g"], "u")).collect()[0].n_distinct == 0


def test_dense_codes(spark):
    words = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("z",)], "w string")
    assert sorted(map(tuple, distinct.dense_codes(words, "w").collect())) == [("a", 1), ("b", 2), ("z", 3)]


SCHEMA = "k int, p string, v double, w string"
OLD = [(1, "a", 1.0, "x"), (2, "a", 2.0, None), (2, "a", 2.0, None), (3, "b", None, "y"), (None, "b", 1.0, "z"), (7, None, 0.0, "q"), (8, "gone/away", 1.0, "x"), (9, "same", 1.0, "x"), (9, "same", 1.0, "x")]
NEW = [(1, "a", 1.0, "x"), (2, "a", 2.0, None), (3, "b", None, "yy"), (None, "b", 1.0, "z"), (7, None, 0.0, "r"), (5, "c", 5.0, None), (9, "same", 1.0, "x"), (9, "same", 1.0, "x")]


def test_row_and_key_differences(spark):
    old, new = (spark.createDataFrame(r, SCHEMA) for r in (OLD, NEW))
    got = {tuple(r) for r in diff.row_diff(old, new).collect()}
    more, less = (a.exceptAll(b).groupBy(*old.columns).count().collect() for a, b in ((new, old), (old, new)))
    assert got == {(*r[:4], "added", r[4]) for r in more} | {(*r[:4], "removed", r[4]) for r in less}
    keyed = {tuple(r) for r in diff.keyed_diff(old, new, ["k"]).collect()}
    assert keyed == {(2, "changed", 2, 1), (3, "changed", 1, 1), (7, "changed", 1, 1), (8, "removed", 1, 0), (5, "added", 0, 1)}
    assert diff.row_diff(old, old).count() == diff.keyed_diff(new, new, ["k"]).count() == 0
    swap = spark.createDataFrame([(1, "a", None, "x")], SCHEMA), spark.createDataFrame([(1, None, None, "x")], SCHEMA)
    assert diff.keyed_diff(*swap, ["k"]).count() == 1  # a null beside a value is no other value
    with pytest.raises(ValueError):
        diff.row_diff(old, new.drop("w"))


def test_only_touched_partitions_are_rewritten(spark, scratch):
    path = scratch + "/t"
    old, new = (spark.createDataFrame(r, SCHEMA) for r in (OLD, NEW))
    assert {r.change for r in diff.rebuild_partitions(old, path, ["p"]).collect()} == {"added"}
    files = lambda: {f for f in spark.read.parquet(path).inputFiles()}
    before = files()
    done = {(r.p, r.change) for r in diff.rebuild_partitions(new, path, ["p"]).collect()}
    assert done == {("a", "changed"), ("b", "changed"), (None, "changed"), ("gone/away", "removed"), ("c", "added")}
    assert rows_of(spark.read.schema(new.schema).parquet(path).select(*new.columns)) == rows_of(new)
    assert {f for f in before if "p=same" in f} == {f for f in files() if "p=same" in f}
    before = files()
    assert diff.rebuild_partitions(new, path, ["p"]).count() == 0 and files() == before
