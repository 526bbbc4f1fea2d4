"""Clustered files: the same rows, and filters that touch few files by their statistics."""

import glob
from datetime import date

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from zonecast.operators import prep
from zonecast.plans import catalog as C
from zonecast.sources.clustered import rank_buckets, write_clustered, z_value


def touched(path, **ranges):
    """Files whose minima and maxima meet all ranges, and files in all."""
    files = glob.glob(path + "/*.parquet")
    hits = 0
    for f in files:
        meta = pq.ParquetFile(f).metadata
        at = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
        ok = False
        for g in range(meta.num_row_groups):
            stats = {c: meta.row_group(g).column(at[c]).statistics for c in ranges}
            ok = ok or all(s.has_min_max and s.min <= hi and s.max >= lo for (lo, hi), s in zip(ranges.values(), stats.values()))
        hits += ok
    return hits, len(files)


def test_slices_and_dates_read_few_files(spark, scratch):
    df = C._clean(spark, "/root/testdata/sf0.01").cache()
    plain, z = scratch + "/plain", scratch + "/z"
    df.repartition(64).write.parquet(plain)
    write_clustered(df, z, ["game_date", "pitch_type", "balls"], 64)
    back = spark.read.parquet(z)
    assert back.columns == df.columns and back.count() == df.count() and df.exceptAll(back).count() == 0
    year = {"game_date": (date(1996, 1, 1), date(1996, 12, 31))}
    for ranges, most in ((year, 0.55), ({"pitch_type": ("SL", "SL")}, 0.55), ({"balls": (1, 1)}, 0.7), ({**year, "pitch_type": ("SL", "SL")}, 0.25), ({**year, "pitch_type": ("SL", "SL"), "balls": (1, 1)}, 0.15)):
        assert touched(plain, **ranges)[0] == 64
        hits, files = touched(z, **ranges)
        assert files >= 48 and 0 < hits <= most * files, (ranges, hits, files)
    one = prep.filter_slice(prep.date_range(back, "1996-01-01", "1996-12-31"), pitch_type="SL", balls=1)
    assert one.count() == prep.filter_slice(prep.date_range(df, "1996-01-01", "1996-12-31"), pitch_type="SL", balls=1).count()
    plan = one._jdf.queryExecution().toString()
    assert "PushedFilters: [" in plan


def test_curve_and_odd_values(spark, scratch):
    df = spark.createDataFrame([(None, None, None), (float("nan"), "", 1), (1.0, "é", 2), (float("inf"), "zz", 3)], "a double, b string, c int")
    zs = df.select(z_value([F.lit(0b10), F.lit(0b11)], 2).alias("z")).first().z
    assert zs == 0b1101
    assert df.select(*rank_buckets(df, ["a", "b", "c"], 4)).count() == 4
    for d, name in ((df, "a"), (df.limit(0), "b"), (spark.range(500).selectExpr("1.0 as a", "'x' as b", "5 as c"), "c")):
        write_clustered(d, f"{scratch}/{name}", ["a", "b", "c"], 4, 4)
        assert spark.read.schema(d.schema).parquet(f"{scratch}/{name}").count() == d.count()
    with pytest.raises(ValueError):
        z_value([F.lit(0)] * 8, 8)
