"""Sources/sinks, model quality floors, the training plan and the streaming build."""

import os

import pytest
from pyspark.ml import Transformer as S_Transformer
from pyspark.sql import functions as F

from zonecast import schema as S
from zonecast.operators import evaluation, features, models, prep, split
from zonecast.plans import catalog as C
from zonecast.plans.dataset import build_processed, prepare_dataset
from zonecast.plans.slices import dashboard_panels, what_if
from zonecast.plans.training import train_and_evaluate
from zonecast.sources import pitch_io
from zonecast.sources.fixture import KEY_COLUMNS, pitch_view
from zonecast.streaming.incremental_prep import start_incremental_prep

SF = "/root/testdata/sf0.001"
TEST_SIZES = {"logistic_regression": {}, "random_forest": {"num_trees": 20, "max_depth": 8}, "boosted_trees": {"max_iter": 20, "max_depth": 4}}


def test_csv_roundtrip_na_and_errors(spark, scratch):
    raw = pitch_view(spark, SF).orderBy(*KEY_COLUMNS)
    path = os.path.join(scratch, "raw.csv")
    raw.limit(200).coalesce(1).write.option("header", True).option("nullValue", "NA").csv(path)
    back = pitch_io.load_pitches(spark, path)
    assert back.count() == 200 and back.schema["release_speed"].dataType.simpleString() == "double"
    assert back.filter(F.col("plate_x").isNull()).count() == raw.limit(200).filter(F.col("plate_x").isNull()).count()
    with pytest.raises(FileNotFoundError):
        pitch_io.load_pitches(spark, os.path.join(scratch, "nope.csv"))
    with pytest.raises(ValueError, match="lacks required columns"):
        pitch_io.load_pitches(spark, path, required=S.REQUIRED_COLUMNS + ["spin_rate"])


def test_csv_numbers_and_missing_tokens(spark, scratch):
    cols = S.REQUIRED_COLUMNS + ["is_strike"]
    good = {c: "1" for c in cols} | {"description": "ball", "release_speed": "90.5", "balls": "1.0", "outs_when_up": "2.0", "pitch_type": "N/A", "stand": "R",
                                     "p_throws": "null", "inning_topbot": "Top", "on_1b": "NaN", "on_2b": "", "is_strike": "0"}
    path = os.path.join(scratch, "p.csv")
    write = lambda *rows: open(path, "w").write("\n".join([",".join(cols), *[",".join(r[c] for c in cols) for r in rows]]) + "\n")
    write(good, good | {"balls": "2", "on_1b": "655555.0"})
    df = pitch_io.load_pitches(spark, path)
    assert df.schema["is_strike"].dataType.simpleString() == "int" and df.schema["balls"].dataType.simpleString() == "int"
    a, b = df.orderBy("balls").collect()
    assert (a.balls, a.outs_when_up, a.pitch_type, a.p_throws, a.on_1b, a.on_2b, a.is_strike) == (1, 2, None, None, None, None, 0)
    assert (b.balls, b.on_1b) == (2, 655555.0)
    assert build_processed(df.drop("is_strike")).count() == 2
    write(good | {"balls": "1.5"})
    with pytest.raises(Exception, match="malformed balls: 1.5"):
        pitch_io.load_pitches(spark, path).collect()
    assert pitch_io.load_pitches(spark, path, malformed="null").first().balls is None


def test_stream_restart_with_defaults_gets_every_row(spark, scratch):
    raw = pitch_view(spark, SF).select(*[f.name for f in S.RAW_PITCH_SCHEMA.fields], *KEY_COLUMNS[:4])
    src, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    for part in (0, 1):
        raw.filter(F.col("l_orderkey") % 2 == part).write.mode("append").parquet(src)
        start_incremental_prep(spark, src, out, schema=raw.schema).awaitTermination(120)
    assert spark.read.parquet(out).count() == 4094


def test_raw_write_skip_and_processed_build(spark, scratch):
    raw = pitch_view(spark, SF)
    p = os.path.join(scratch, "raw.parquet")
    assert pitch_io.save_raw(raw, p) is True
    assert pitch_io.save_raw(raw.limit(1), p) is False          # exists, not overwritten
    assert spark.read.parquet(p).count() == 6000
    plan = build_processed(pitch_io.load_pitches(spark, p, where=prep.speed_condition()))._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(release_speed" in plan.split("PushedFilters")[1]
    out = prepare_dataset(spark, p, os.path.join(scratch, "processed"), partition_by=["stand"])
    assert out.count() == 1465 + 2629


def test_metrics_json_csv_and_lookup(spark, scratch):
    m = spark.createDataFrame([("baseline", 0.5, 0.5, 1.0, 0.6, float("nan"))], S.METRICS_SCHEMA)
    base = os.path.join(scratch, "metrics_test")
    pitch_io.save_metrics(m, base)
    assert pitch_io.get_model_metrics(spark, base, "baseline")["roc_auc"] is None
    assert pitch_io.get_model_metrics(spark, base, "forest") is None
    assert pitch_io.get_model_metrics(spark, os.path.join(scratch, "none"), "baseline") is None


@pytest.fixture(scope="module")
def split_df(spark):
    return split.stratified_split(C._clean(spark, "/root/testdata/sf0.01"), KEY_COLUMNS).cache()


@pytest.mark.parametrize("name,floor", [("logistic_regression", 0.70), ("random_forest", 0.78),
                                        ("boosted_trees", 0.78)])
def test_model_auc_floors(spark, split_df, name, floor):
    st = features.fit_state(split_df)
    train = split_df.filter("split = 'train'")
    test = split_df.filter("split = 'test'")
    m = models.fit_model(train, st, name, **TEST_SIZES[name])
    auc = evaluation.roc_auc(models.score(m, test, st, name)).first()["roc_auc"]
    assert auc >= floor, auc
    imp = models.feature_importance(m, st).collect()
    assert len(imp) == len(st.feature_names()) and imp[0]["importance"] >= imp[-1]["importance"]


def test_baseline_auc_half(spark, split_df):
    p = models.baseline_scores(split_df.filter("split = 'train'"), split_df.filter("split = 'test'"))
    r = evaluation.metrics_by_model(p).first()
    # balls are the majority in the fixture, so the baseline always says ball
    assert r.roc_auc == 0.5 and r.recall == 0.0 and r.precision == 0.0
    assert r.accuracy == pytest.approx(5338 / 8381)


def test_training_plan_save_load_and_what_if(spark, scratch):
    proc = C._clean(spark, SF)
    out = train_and_evaluate(spark, proc, KEY_COLUMNS, ("baseline", "logistic_regression", "random_forest"),
                             sizes={"random_forest": {"num_trees": 5, "max_depth": 4}},
                             models_dir=os.path.join(scratch, "models"), metrics_base=os.path.join(scratch, "metrics"))
    names = {r["model"] for r in out["metrics_test"].collect()}
    assert names == {"baseline", "logistic_regression", "random_forest"}
    assert pitch_io.list_models(spark, os.path.join(scratch, "models")) == ["logistic_regression", "random_forest"]
    with pytest.raises(FileNotFoundError, match="saved there"):
        pitch_io.load_model(spark, os.path.join(scratch, "models"), "xgboost")
    m = pitch_io.load_model(spark, os.path.join(scratch, "models"), "random_forest")
    st = features.FeatureState.load(spark, os.path.join(scratch, "models", "_feature_state"))
    assert st.feature_names() == out["state"].feature_names()
    scen = proc.select(*KEY_COLUMNS, "plate_x", "plate_z", "balls", "strikes", "pitch_type", "stand").limit(50)
    w = what_if(m, st, scen, KEY_COLUMNS).collect()
    assert len(w) == 50 and all(r["band"] in ("high", "moderate", "low") for r in w)
    assert pitch_io.get_model_metrics(spark, os.path.join(scratch, "metrics_test"), "baseline")["roc_auc"] == 0.5


def test_dashboard_panels(spark):
    proc = C._clean(spark, SF)
    panels = dashboard_panels(proc, ["FF", "SL"], None, "FF", 15, "prob", {"balls": 0})
    sv = panels["shown_vs_total"].first()
    assert sv.n_total == 4094 and 0 < sv.n_shown < sv.n_total
    assert panels["overview"].first().n_pitches == sv.n_shown
    assert panels["zone_grid"].count() == 9


def test_panels_of_empty_and_tiny_slices(spark):
    proc = C._clean(spark, SF).cache()
    for i, (types, df) in enumerate((([], proc), (["FF"], proc.filter("pitch_type = 'FF'").limit(9)), (["FF"], proc.filter("pitch_type = 'FF'").limit(4)), (["FF"], proc.limit(0)))):
        spark.sparkContext.setJobGroup(f"build{i}", "build")
        panels = dashboard_panels(df, types, None, "FF")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(f"build{i}")
        assert panels["heatmap"].count() == 0
        assert panels["zone_grid"].count() == 9
        rows = {n: f.count() for n, f in panels.items()}
        assert rows["overview"] == 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    proc.unpersist()


def test_streaming_prep_equals_batch(spark, scratch):
    raw = pitch_view(spark, SF).select(*[f.name for f in S.RAW_PITCH_SCHEMA.fields], *KEY_COLUMNS[:4])
    src = os.path.join(scratch, "incoming")
    raw.repartition(3).write.parquet(src)
    schema = spark.read.parquet(src).schema
    out = os.path.join(scratch, "stream_out")
    q = start_incremental_prep(spark, src, out, checkpoint=os.path.join(scratch, "ckpt"), schema=schema)
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    exp = build_processed(spark.read.parquet(src))
    assert got.count() == exp.count() == 4094
    assert got.exceptAll(exp.select(*got.columns)).count() == 0


def test_cli_prepare_train_evaluate(spark, scratch):
    from zonecast import cli
    from zonecast.plans.training import evaluate_saved_models
    raw = os.path.join(scratch, "raw")
    pitch_view(spark, SF).write.parquet(raw)
    proc = os.path.join(scratch, "proc")
    cli.main(["prepare", "--raw", raw, "--out", proc])
    keys = ",".join(KEY_COLUMNS)
    mdir, mbase = os.path.join(scratch, "m"), os.path.join(scratch, "metrics")
    cli.main(["train", "--processed", proc, "--models", mdir, "--metrics", mbase, "--keys", keys,
              "--model-names", "baseline,logistic_regression"])
    again = evaluate_saved_models(spark, spark.read.parquet(proc), KEY_COLUMNS, mdir)
    trained = {r["model"]: r for r in pitch_io.read_metrics(spark, mbase + "_test").collect()}
    for r in again.collect():
        assert r["accuracy"] == pytest.approx(trained[r["model"]]["accuracy"])


def test_a_fit_spreads_rows_that_lie_in_one_partition(spark, monkeypatch):
    """As from a file with one row group; and it has few more tasks than cores."""
    seen = []

    class Model(S_Transformer):
        def _transform(self, df):
            return df

    class Estimator:
        def fit(self, data):
            seen.append([r["count"] for r in data.groupBy(F.spark_partition_id()).count().collect()])
            return Model()

    monkeypatch.setattr(models, "make_estimator", lambda *a, **kw: Estimator())
    monkeypatch.setattr(models, "ROWS_PER_TASK", 100)
    st = features.FeatureState(["x"], {"x": 0.0}, [])
    rows = spark.range(0, 4000, 1, 40).selectExpr("cast(id as double) as x", "cast(id % 2 as int) as is_strike")
    models.fit_model(rows.filter("x >= 3900"), st, "random_forest")
    models.fit_model(rows.filter("x >= 400").coalesce(1), st, "random_forest")
    models.fit_model(rows, st, "random_forest")
    small, one, even = seen
    assert sum(small) == 100 and len(small) == 1
    assert sum(one) == 3600 and len(one) == spark.sparkContext.defaultParallelism and max(one) < 1.5 * 3600 / len(one)
    assert sum(even) == 4000 and len(even) == spark.sparkContext.defaultParallelism


def test_registered_scores_fit_the_whole_model(spark, monkeypatch):
    """No query passes a size: boosting runs all of its 200 rounds."""
    seen = {}

    def fit(train, state, name, **kw):
        seen[name] = models.make_estimator(name, 100, **kw)
        raise KeyError(name)

    monkeypatch.setattr(C, "settled", lambda df, name: df)
    monkeypatch.setattr(C, "_split", lambda spark, d: spark.range(2).withColumn("split", F.lit("train")))
    monkeypatch.setattr(C.features, "fit_state", lambda df: None)
    monkeypatch.setattr(C.features, "transform", lambda df, state, keep: df)
    monkeypatch.setattr(C.models, "fit_model", fit)
    for query, name in ((C.q_boosted_scores, "boosted_trees"), (C.q_forest_scores, "random_forest"), (C.q_logistic_scores, "logistic_regression")):
        with pytest.raises(KeyError, match=name):
            query(spark, SF)
    assert seen["boosted_trees"].getMaxIter() == 200 and seen["boosted_trees"].getMaxDepth() == 6
    assert seen["random_forest"].getNumTrees() == 200 and seen["logistic_regression"].getMaxIter() == 1000


def test_logistic_regression_keeps_rows_once_and_in_small_parts(spark, monkeypatch):
    """Spark keeps its own copy; a large partition held in one piece ended the JVM."""
    seen = {}

    class Model(S_Transformer):
        def _transform(self, df):
            return df

    class Estimator:
        def fit(self, data):
            seen["parts"] = [r["count"] for r in data.groupBy(F.spark_partition_id()).count().collect()]
            seen["kept"] = len(spark.sparkContext._jsc.getPersistentRDDs()) - before
            return Model()

    monkeypatch.setattr(models, "make_estimator", lambda *a, **kw: Estimator())
    monkeypatch.setattr(models, "ROWS_PER_TASK", 10)
    monkeypatch.setattr(models, "MOST_ROWS_PER_TASK", 100)
    st = features.FeatureState(["x"], {"x": 0.0}, [])
    rows = spark.range(0, 4000, 1, 4).selectExpr("cast(id as double) as x", "cast(id % 2 as int) as is_strike")
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    models.fit_model(rows, st, "logistic_regression")
    assert seen["kept"] == 0 and sum(seen["parts"]) == 4000 and max(seen["parts"]) <= 200
