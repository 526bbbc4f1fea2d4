"""Windowed stream rates: repeats, disorder, late rows and restarts against the batch result."""

from datetime import datetime, timedelta

from pyspark.sql import types as T

from zonecast.streaming import summaries as S

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.TimestampType()), T.StructField("k", T.StringType()), T.StructField("y", T.IntegerType())])
START = datetime(2024, 1, 1)


def put(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def row(i, minutes, k="a", y=1):
    return (i, START + timedelta(minutes=minutes), k, y)


def run(spark, scratch):
    q = S.start_windowed_rates(spark, f"{scratch}/in/*", f"{scratch}/out", SCHEMA, key_cols=["id"], time_col="t", by=["k"], label_col="y")
    q.awaitTermination()
    return q


def out(spark, scratch):
    return sorted((r.k, r.window_start, r.n_rows, r.n_strikes) for r in spark.read.parquet(f"{scratch}/out").collect())


def test_restart_repeats_and_disorder_equal_batch(spark, scratch):
    rows = [row(i, i * 3 + (i * 37 % 50), "ab"[i % 3 == 0], i % 2) for i in range(300)]
    for n in range(3):
        put(spark, f"{scratch}/in", f"p{n}", rows[n * 60:(n + 1) * 60] + rows[n * 60:n * 60 + 20])  # every file repeats some of its rows
    run(spark, scratch)
    first = out(spark, scratch)
    for n in range(3, 5):
        put(spark, f"{scratch}/in", f"p{n}", rows[n * 60:(n + 1) * 60] + rows[n * 60 - 10:n * 60])  # and some of the file before
    put(spark, f"{scratch}/in", "end", [row(9999, 100_000)])  # the watermark passes all
    q = run(spark, scratch)  # a restart: state and progress are read back
    assert S.late_rows(q) == 0
    run(spark, scratch)
    got = out(spark, scratch)
    assert set(first) <= set(got) and len(got) == len(set(got))
    batch = S.windowed_rates(spark.createDataFrame(rows, SCHEMA), "t", "1 hour", ["k"], "y").collect()
    assert got == sorted((r.k, r.window_start, r.n_rows, r.n_strikes) for r in batch)


def test_late_rows_are_dropped_and_counted(spark, scratch):
    put(spark, f"{scratch}/in", "p0", [row(1, 0), row(2, 600)])
    run(spark, scratch)  # the watermark is two hours behind minute 600
    put(spark, f"{scratch}/in", "p1", [row(3, 10), row(4, 470), row(5, 500), row(6, 610)])
    q = run(spark, scratch)
    put(spark, f"{scratch}/in", "p2", [row(9, 100_000)])
    run(spark, scratch)
    assert S.late_rows(q) == 2  # minutes 10 and 470
    assert [(r[1], r[2]) for r in out(spark, scratch)] == [(START + timedelta(hours=h), n) for h, n in ((0, 1), (8, 1), (10, 2))]
