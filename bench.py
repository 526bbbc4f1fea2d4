"""Headline-query benchmark.

Runs the dataset build once (lineitem-derived raw pitches -> processed parquet in
the shared checkpoint folder), then the headline operators over the processed
table, each forced end to end with the ``noop`` sink.  Prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from zonecast import schema as S  # noqa: E402
from zonecast.operators import cube, evaluation, features, models, ordered, prep, split, summaries, zones  # noqa: E402
from zonecast.plans.dataset import build_processed  # noqa: E402
from zonecast.session import build_session, shared_path  # noqa: E402
from zonecast.sources.fixture import KEY_COLUMNS, pitch_view  # noqa: E402


def run(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), app="zonecast-bench")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    times = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)

    # warm the JVM / parquet reader so the first query is not charged for it
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").limit(1).collect()

    processed_path = shared_path(spark, f"bench-processed-{uuid.uuid4().hex}")
    raw = pitch_view(spark, sf_dir)
    timed("prepare_dataset", lambda: build_processed(raw).write.mode("overwrite").parquet(processed_path))
    df = spark.read.parquet(processed_path)
    labeled = prep.label_outcomes(raw)

    timed("cleaning_audit", lambda: run(prep.cleaning_audit(labeled)))
    timed("overview_totals", lambda: run(summaries.overview_totals(df)))
    timed("rate_by_pitch_type", lambda: run(summaries.rate_by(df, "pitch_type")))
    timed("rate_by_count", lambda: run(summaries.rate_by_count(df)))
    timed("describe_by_class", lambda: run(summaries.describe_by_class(df, "release_speed", "is_strike")))
    timed("median_profile", lambda: run(summaries.median_profile(df, S.NUMERIC_CONTEXT + S.NUMERIC_PITCH)))
    timed("zone_heatmap", lambda: run(zones.zone_heatmap(df, 25)))
    timed("zone_heatmap_dense", lambda: run(zones.zone_heatmap_dense(df, 25)))
    timed("zone_grid_prob", lambda: run(zones.zone_grid(df, "prob")))
    timed("speed_histogram", lambda: run(zones.speed_histogram(df)))
    state_cells = {}

    def cells():
        state_cells["cells"] = cube.dashboard_cells(df)
    timed("slice_cells", cells)
    timed("slice_cube", lambda: run(cube.slice_cube(state_cells["cells"], ["pitch_type", "stand", "p_throws", "balls", "strikes"])))
    timed("panels_from_cells", lambda: [run(f(state_cells["cells"])) for f in (cube.totals, lambda c: cube.rate_by(c, "pitch_type"), cube.rate_by_count_label, cube.zone_grid_scaled)])
    order = ["game_date", "l_orderkey", "l_partkey", "l_linenumber"]
    timed("rolling_strike_rate", lambda: run(ordered.rolling(df.select("l_suppkey", *order, "is_strike"), ["l_suppkey"], order, 50, {"n": F.count("is_strike"), "s": F.sum("is_strike")})))
    strikes = df.where("is_strike = 1").select("l_suppkey", *order)
    timed("asof_last_strike", lambda: run(ordered.asof_join(df.select("l_suppkey", *order), strikes, "game_date", "game_date", ["l_suppkey"], ["l_suppkey"], ties=order[1:], allow_equal=False)))

    state = {}

    def feat():
        state["st"] = features.fit_state(df)
        run(features.transform(df, state["st"], keep=KEY_COLUMNS + ["is_strike"]))
    timed("feature_matrix", feat)

    split_path = shared_path(spark, f"bench-split-{uuid.uuid4().hex}")
    timed("stratified_split", lambda: split.stratified_split(df, KEY_COLUMNS).write.parquet(split_path))
    s = spark.read.parquet(split_path)
    test, train = s.filter("split = 'test'"), s.filter("split = 'train'")

    def rule(t):
        e = features.add_engineered(t)
        sc = F.lit(1.0) / (F.lit(1.0) + F.floor(F.lit(4.0) * F.coalesce(F.col("dist_to_zone_center"), F.lit(100.0))))
        return e.select(*KEY_COLUMNS, F.lit("zone_rule").alias("model"), F.col("is_strike").alias("label"),
                        F.when(sc >= 0.5, 1).otherwise(0).alias("prediction"), sc.alias("score"))
    preds = models.baseline_scores(train, test, KEY_COLUMNS).unionByName(rule(test))
    timed("metrics_by_model", lambda: run(evaluation.metrics_by_model(preds)))
    timed("roc_curve", lambda: run(evaluation.roc_curve(preds)))

    def fit_and_score(name, **kw):
        st = state["st"]
        fm_train = features.transform(train, st, keep=["is_strike"])
        fm_test = features.transform(test, st, keep=KEY_COLUMNS + ["is_strike"])
        mdl = models.fit_model(fm_train, st, name, **kw)
        run(evaluation.metrics_by_model(models.score(mdl, fm_test, st, name, KEY_COLUMNS)))
    timed("logistic_regression", lambda: fit_and_score("logistic_regression"))
    timed("random_forest_20", lambda: fit_and_score("random_forest", num_trees=20, max_depth=8))
    timed("boosted_trees_20", lambda: fit_and_score("boosted_trees", max_iter=20))

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_headline_sec", "value": total, "unit": "sec", "queries": times,
                      "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
