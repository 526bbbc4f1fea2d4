"""Unit tests on tiny frames: edges, nulls, NaN, empty input, absent columns."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from zonecast import schema as S
from zonecast.operators import evaluation, features, prep, roster, selection, split, summaries, zones

NAN = float("nan")


def pitches(spark, rows, cols="plate_x double, plate_z double, is_strike int"):
    return spark.createDataFrame(rows, cols)


# --- labels and cleaning -----------------------------------------------------------

def test_label_exact_and_case_sensitive(spark):
    df = spark.createDataFrame([("foul",), ("Foul",), ("ball",), (None,), ("hit_into_play",), ("pitchout",)],
                               "description string")
    out = {r["description"]: r["is_strike"] for r in prep.label_outcomes(df).collect()}
    assert out == {"foul": 1, "ball": 0, "pitchout": 0}
    a = prep.label_audit(df).first()
    assert (a.n_input, a.n_kept, a.n_strikes, a.n_balls, a.n_dropped) == (6, 3, 1, 2, 3)


def test_speed_bounds_edges_nan_null(spark):
    speeds = [59.9, 60.0, 105.0, 105.1, NAN, None]
    df = spark.createDataFrame([(s,) for s in speeds], "release_speed double")
    kept = sorted(r[0] for r in prep.speed_bounds(df).collect())
    assert kept == [60.0, 105.0]
    # absent column: no-op
    other = spark.createDataFrame([(1,)], "x int")
    assert prep.speed_bounds(other).count() == 1


def test_drop_missing_only_present_columns(spark):
    df = spark.createDataFrame([(1.0, None, 1), (NAN, 2.0, 1), (1.0, 2.0, None), (1.0, 2.0, 0)],
                               "plate_x double, plate_z double, balls int")
    assert prep.drop_missing_critical(df).count() == 1


def test_cleaning_audit_attributes_first_failing_step(spark):
    df = spark.createDataFrame([(50.0, 1.0, 1.0, 0, 0, 1), (90.0, None, None, 0, 0, 1), (90.0, 1.0, 1.0, 0, 0, 1)],
                               "release_speed double, plate_x double, plate_z double, balls int, strikes int, is_strike int")
    got = {r["step"]: r["n_rows"] for r in prep.cleaning_audit(df).collect()}
    assert got == {"release_speed": 1, "plate_x": 1, "kept": 1}


def test_multiselect_asymmetry(spark):
    df = spark.createDataFrame([("FF", "A B"), ("SL", "C D")], "pitch_type string, pitcher_name string")
    assert prep.filter_multiselect(df, []).count() == 0
    assert prep.filter_multiselect(df, ["FF", "SL"], []).count() == 2
    assert prep.filter_multiselect(df, ["FF", "SL"], ["C D"]).count() == 1
    r = prep.shown_vs_total(df, prep.multiselect_condition(df, ["FF"])).first()
    assert (r.n_shown, r.n_total) == (1, 2)


def test_filter_slice_all_and_absent(spark):
    df = spark.createDataFrame([("FF", 1), ("SL", 2)], "pitch_type string, balls int")
    assert prep.filter_slice(df, pitch_type="All", balls=2, stand="R").count() == 1


def test_min_rows_gate(spark):
    df = spark.range(7)
    assert prep.min_rows_gate(df, 5).count() == 7
    assert prep.min_rows_gate(df, 10).count() == 0


def test_derive_name_and_first_non_empty(spark):
    df = spark.createDataFrame([("A", "B"), (None, "C")], "pitcher_first string, pitcher_last string")
    assert [r.pitcher_name for r in prep.derive_name(df).orderBy("pitcher_last").collect()] == ["A B", None]
    t = spark.createDataFrame([("", "R"), (None, "L"), ("R", "L"), ("", "")], "a string, b string")
    assert [r[0] for r in t.select(prep.first_non_empty("a", "b")).collect()] == ["R", "L", "R", ""]


def test_missing_profile_counts_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (NAN, None), (None, "b")], "x double, s string")
    got = {r["column"]: r["n_missing"] for r in summaries.missing_profile(df).collect()}
    assert got == {"x": 2, "s": 1}


# --- exact selection engine ------------------------------------------------------------

def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.normal(size=3000), np.full(2000, 0.25), rng.integers(0, 5, 1000).astype(float)])
    grp = np.arange(len(vals)) % 3
    pdf = pd.DataFrame({"g": grp, "v": vals})
    df = spark.createDataFrame(pdf)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = selection.exact_quantiles(df, "v", probs, ["g"]).collect()
    assert len(got) == 3 * len(probs)
    for r in got:
        exp = np.quantile(pdf[pdf.g == r["g"]].v.to_numpy(), r["prob"])
        assert math.isclose(r["quantile"], exp, rel_tol=1e-12, abs_tol=1e-12)


def test_medians_null_nan_and_all_null(spark):
    df = spark.createDataFrame([(1.0, None), (NAN, None), (3.0, None), (None, None)], "a double, b double")
    assert selection.column_medians(df, ["a", "b"]) == {"a": 2.0, "b": None}


def test_prefix_sums_multi_range(spark):
    pdf = pd.DataFrame({"k": np.arange(500) % 2, "o": np.arange(500) * 1.5, "x": np.arange(500) % 7})
    df = spark.createDataFrame(pdf)
    out = selection.ordered_prefix_sums(df, "o", ["x"], ["k"]).toPandas()
    for k, g in pdf.groupby("k"):
        exp = g.sort_values("o").x.cumsum().to_numpy()
        got = out[out.k == k].sort_values("o").cum_x.to_numpy()
        assert (exp == got).all()


def test_quantiles_with_infinities_nulls_and_integers(spark):
    inf = float("inf")
    rows = [("a", v) for v in [1.0, 2.0, inf, -inf, 5.0]] + [(None, 3.0), (None, 7.0), ("b", NAN), ("b", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r["g"], r["prob"]): (r["quantile"], r["n"]) for r in selection.exact_quantiles(df, "v", [0.0, 0.5, 1.0], ["g"]).collect()}
    assert got == {("a", 0.0): (-inf, 5), ("a", 0.5): (2.0, 5), ("a", 1.0): (inf, 5),
                   (None, 0.0): (3.0, 2), (None, 0.5): (5.0, 2), (None, 1.0): (7.0, 2)}
    big = spark.range(2**53, 2**53 + 5).withColumnRenamed("id", "v")
    assert selection.exact_quantiles(big, "v", [0.5]).first()["quantile"] == float(2**53 + 2)
    assert selection.exact_quantiles(df.limit(0), "v", [0.5], ["g"]).count() == 0


def test_quantiles_of_many_groups_and_a_hot_one(spark):
    df = spark.range(400_000).select(F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id")).alias("g"),
                                     (F.col("id") / 2).alias("v"))
    out = selection.exact_quantiles(df, "v", [0.5], ["g"])
    assert out.count() == 200_001
    hot = out.filter("g = -1").first()
    assert (hot["n"], hot["quantile"]) == (200_000, 199_999 / 2)
    assert out.filter("g <> -1 and (quantile <> g / 2 or n <> 1)").count() == 0


# --- zones ------------------------------------------------------------------------------

def test_zone_grid_edges(spark):
    xs = [-0.83, -0.8301, 0.83, 0.8301, None]
    df = pitches(spark, [(x, 2.0, 1) for x in xs])
    g = {r["zone"]: r["n_pitches"] for r in zones.zone_grid(df, "count").collect()}
    assert sum(g.values()) == 2 and g[7] == 1 and g[9] == 1  # bottom row (z=2.0 < 2.1667), left and right cells
    zb = pitches(spark, [(0.0, 1.5, 1), (0.0, 3.5, 0)])
    g2 = {r["zone"]: r["value"] for r in zones.zone_grid(zb, "prob").collect()}
    assert g2[8] == 1.0 and g2[2] == 0.0 and len(g2) == 9


def test_heatmap_counts_sum_and_single_value_axis(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"plate_x": rng.normal(size=500), "plate_z": rng.normal(2.5, 1, 500),
                        "is_strike": rng.integers(0, 2, 500).astype("int32")})
    df = spark.createDataFrame(pdf)
    cells = zones.zone_heatmap(df, 20).toPandas()
    assert cells.n_pitches.sum() == 500
    xb = pd.cut(pdf.plate_x, np.linspace(pdf.plate_x.min(), pdf.plate_x.max(), 21), labels=False, include_lowest=True)
    zb = pd.cut(pdf.plate_z, np.linspace(pdf.plate_z.min(), pdf.plate_z.max(), 21), labels=False, include_lowest=True)
    exp = pdf.assign(x_bin=xb, z_bin=zb).groupby(["x_bin", "z_bin"]).is_strike.agg(["count", "mean"])
    got = cells.set_index(["x_bin", "z_bin"]).sort_index()
    assert (got.n_pitches.to_numpy() == exp["count"].to_numpy()).all()
    got = {(r["x_bin"], r["z_bin"]) for r in zones.zone_heatmap(pitches(spark, [(1.0, 2.0, 1), (1.0, 3.0, 0)]), 5).collect()}
    cut = pd.cut(pd.Series([1.0, 1.0]), 5, labels=False)
    assert got == {(int(cut[0]), 0), (int(cut[0]), 4)}
    none = pitches(spark, [(1.0, 2.0, 1)]).limit(0)
    assert zones.zone_heatmap(none, 5).count() == 0 and zones.zone_heatmap_dense(none, 5).count() == 0


def test_histogram_matches_numpy_and_widens(spark):
    rng = np.random.default_rng(3)
    v = np.round(rng.normal(90, 4, 400), 1)
    pdf = pd.DataFrame({"release_speed": v, "is_strike": (np.arange(400) % 2).astype("int32")})
    h = zones.speed_histogram(spark.createDataFrame(pdf)).toPandas()
    for c, g in pdf.groupby("is_strike"):
        counts, _ = np.histogram(g.release_speed, bins=30)
        got = np.zeros(30, dtype=int)
        for _, r in h[h.is_strike == c].iterrows():
            got[int(r["bin"])] = r["n"]
        assert (got == counts).all()
    one = spark.createDataFrame([(90.0, 1), (90.0, 1)], "release_speed double, is_strike int")
    r = zones.speed_histogram(one).collect()
    assert len(r) == 1 and r[0]["n"] == 2 and r[0]["bin"] == 15  # numpy widens to [89.5, 90.5]


# --- features ----------------------------------------------------------------------------

def test_one_hot_drop_first_unseen_and_null(spark):
    train = spark.createDataFrame([("FF", 1.0), ("SL", 2.0), (None, 3.0)], "pitch_type string, balls double")
    st = features.fit_state(train, numeric=["balls"], categorical=["pitch_type"])
    assert st.categories["pitch_type"] == ["FF", "SL", "Unknown"]
    assert st.feature_names() == ["balls", "pitch_type_SL", "pitch_type_Unknown"]
    new = spark.createDataFrame([("KN", None), (None, 5.0), ("SL", 1.0)], "pitch_type string, balls double")
    rows = features.transform(new, st).collect()
    assert [tuple(r) for r in rows] == [(2.0, 0.0, 0.0), (5.0, 0.0, 1.0), (1.0, 1.0, 0.0)]


def test_engineered_absent_and_imputed_by_own_median(spark):
    df = spark.createDataFrame([(0.0, 2.0, 3.0, 1.0), (1.0, 2.0, None, 1.0), (0.0, 3.0, 3.5, 1.5)],
                               "plate_x double, plate_z double, sz_top double, sz_bot double")
    e = features.add_engineered(df)
    st = features.fit_state(df, numeric=["sz_top", "zone_mid", "dist_to_zone_center"], categorical=[])
    assert st.medians["zone_mid"] == pytest.approx(2.25)
    out = features.transform(df, st).collect()
    assert out[1]["zone_mid"] == pytest.approx(2.25)  # null zone_mid takes its own median
    noz = features.add_engineered(spark.createDataFrame([(1.0,)], "plate_x double")).first()
    assert noz["zone_mid"] == 0.0 and noz["dist_to_zone_center"] == 0.0
    assert e.count() == 3


def test_serving_rules(spark):
    ref = spark.createDataFrame([(0.0, 2.0, 3.0, 1.0, 1), (0.5, 2.5, 3.4, 1.6, 2)],
                                "plate_x double, plate_z double, sz_top double, sz_bot double, balls int")
    st = features.fit_state(ref, numeric=["balls", "plate_x", "plate_z", "sz_top", "sz_bot", "zone_mid",
                                           "dist_to_zone_center"], categorical=[])
    sc = spark.createDataFrame([(None, 2.0, 1.0, None)], "plate_x double, plate_z double, sz_bot double, balls int")
    r = features.featurize_with_state(sc, st).first()
    assert r["sz_top"] == pytest.approx(3.2)             # absent column -> reference median
    assert r["zone_mid"] == pytest.approx(2.1)
    assert r["dist_to_zone_center"] == 0.0               # engineered null -> 0.0 when serving
    assert r["balls"] == 1.5 and r["plate_x"] == 0.25    # other nulls -> medians


# --- split ----------------------------------------------------------------------------------

def test_split_disjoint_complete_stable(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 3 == 0).cast("int").alias("is_strike"))
    a = split.stratified_split(df, ["id"]).cache()
    b = split.stratified_split(df.repartition(7), ["id"])
    assert a.count() == 5000
    per = {(r["is_strike"], r["split"]): r["count"] for r in a.groupBy("is_strike", "split").count().collect()}
    n1, n0 = 1667, 3333
    assert per[(1, "test")] == round(0.2 * n1) and per[(0, "test")] == round(0.2 * n0)
    assert a.join(b, ["id", "split"]).count() == 5000
    un = split.stratified_split(df, ["id"], stratify=False)
    assert un.filter("split = 'test'").count() == 1000


def test_split_keys_must_identify_rows(spark):
    one = spark.range(1000).select(F.lit(7).alias("id"), F.lit(1).alias("is_strike"))
    with pytest.raises(ValueError, match="not unique"):
        split.stratified_split(one, ["id"])
    nulls = spark.createDataFrame([(None, "a", 1), ("a", None, 1), ("a", "", 1), ("", "a", 1)], "x string, y string, is_strike int")
    assert nulls.select(split.split_hash(["x", "y"]).alias("h")).distinct().count() == 4
    assert split.stratified_split(nulls, ["x", "y"], test_size=0.5).filter("split = 'test'").count() == 2
    assert split.stratified_split(nulls.limit(0), ["x", "y"]).count() == 0


def test_split_takes_the_smallest_hashes(spark):
    df = spark.range(3000).select("id", (F.col("id") % 2).cast("int").alias("is_strike"))
    got = split.stratified_split(df, ["id"]).toPandas()
    pdf = df.toPandas()
    pdf["h"] = [__import__("hashlib").md5(f"42|{i}".encode()).hexdigest() for i in pdf.id]
    exp = set()
    for c, g in pdf.groupby("is_strike"):
        exp |= set(g.sort_values("h").id[: round(0.2 * len(g))])
    assert set(got[got.split == "test"].id) == exp


# --- evaluation -------------------------------------------------------------------------------

GOLDEN = {
    "baseline_test": ((3415, 2496, 0, 0), (0.5777364236169853, 0.5777364236169853, 1.0, 0.7323611408964186)),
    "logistic_test": ((2979, 616, 436, 1880), (0.8220267298257486, 0.8286509040333797, 0.8723279648609078, 0.8499286733238232)),
    "forest_test": ((2904, 352, 511, 2144), (0.854001015056674, 0.8918918918918919, 0.8503660322108345, 0.8706340878429021)),
    "boosted_test": ((2961, 417, 454, 2079), (0.8526476061580105, 0.8765541740674956, 0.8670571010248902, 0.8717797732960401)),
    "forest_train": ((13660, 0, 0, 9982), (1.0, 1.0, 1.0, 1.0)),
    "boosted_train": ((13390, 297, 270, 9685), (0.9760172574232299, 0.9783005771900344, 0.9802342606149341, 0.9792664643288113)),
}


def test_golden_metrics(spark):
    rows = [(k, tp, fp, fn, tn) for k, ((tp, fp, fn, tn), _) in GOLDEN.items()]
    counts = spark.createDataFrame(rows, "model string, tp long, fp long, fn long, tn long")
    got = {r["model"]: r for r in evaluation.metrics_from_counts(counts).collect()}
    for k, (_, exp) in GOLDEN.items():
        r = got[k]
        for a, b in zip((r.accuracy, r.precision, r.recall, r.f1), exp):
            assert abs(a - b) < 1e-12, (k, a, b)


def _auc_brute(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))


def test_auc_ties_and_curve(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 600)
    s = np.round(rng.random(600) * 0.5 + y * 0.3, 1)
    pdf = pd.DataFrame({"model": "m", "label": y.astype("int32"), "prediction": (s >= 0.5).astype("int32"), "score": s})
    df = spark.createDataFrame(pdf)
    auc = evaluation.roc_auc(df).first()["roc_auc"]
    assert auc == pytest.approx(_auc_brute(y, s), abs=1e-12)
    curve = evaluation.roc_curve(df).toPandas()
    pts = curve.sort_values(["fpr", "tpr"])
    assert pts.iloc[0][["fpr", "tpr"]].tolist() == [0.0, 0.0] and pts.iloc[-1][["fpr", "tpr"]].tolist() == [1.0, 1.0]
    assert (np.diff(pts.tpr.to_numpy()) >= 0).all()
    assert len(curve) == len(np.unique(s)) + 1


def test_auc_one_class_is_null_and_constant_is_half(spark):
    one = spark.createDataFrame([("m", 1, 1, 0.3), ("m", 1, 1, 0.9)], "model string, label int, prediction int, score double")
    assert evaluation.roc_auc(one).first()["roc_auc"] is None
    const = spark.createDataFrame([("b", 1, 1, 1.0), ("b", 0, 1, 1.0), ("b", 1, 1, 1.0)],
                                  "model string, label int, prediction int, score double")
    m = evaluation.metrics_by_model(const).first()
    assert m.roc_auc == 0.5 and m.precision == pytest.approx(2 / 3) and m.recall == 1.0


def test_zero_denominators(spark):
    df = spark.createDataFrame([("m", 0, 0, 0.1)], "model string, label int, prediction int, score double")
    m = evaluation.classification_metrics(df).first()
    assert (m.accuracy, m.precision, m.recall, m.f1) == (1.0, 0.0, 0.0, 0.0)


def test_auc_of_many_scores_equals_brute_force_in_few_jobs(spark):
    rng = np.random.default_rng(8)
    y = rng.integers(0, 2, 4000)
    s = rng.random(4000) * 0.7 + y * 0.3
    df = spark.createDataFrame(pd.DataFrame({"model": np.where(np.arange(4000) % 4 == 0, "a", "b"), "label": y.astype("int32"),
                                             "prediction": (s >= 0.5).astype("int32"), "score": s}))
    spark.sparkContext.setJobGroup("auc", "auc")
    got = {r["model"]: r["roc_auc"] for r in evaluation.metrics_by_model(df).collect()}
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("auc"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    pick = np.arange(4000) % 4 == 0
    assert got["a"] == pytest.approx(_auc_brute(y[pick], s[pick]), abs=1e-12)
    assert got["b"] == pytest.approx(_auc_brute(y[~pick], s[~pick]), abs=1e-12)
    assert jobs < 20  # adaptive execution counts each shuffle as a job


# --- roster and union ---------------------------------------------------------------------------

def test_roster_first_match_and_coverage(spark):
    people = spark.createDataFrame([("A", "B", 5), ("A", "B", 3), ("C", "D", None), ("E", "F", 9)],
                                   "name_first string, name_last string, player_id long")
    r = roster.roster_frame(spark, [{"first": "A", "last": "B", "throws": "R"}, {"first": "C", "last": "D"},
                                    {"first": "X", "last": "Y", "handedness": "L"}])
    ids = {(x["first"], x["player_id"]) for x in roster.resolve_ids(r, people).collect()}
    assert ids == {("A", 3)}
    pitches_df = spark.createDataFrame([(3, 1), (3, 0), (9, 1)], "pid long, is_strike int")
    tagged = roster.tag_pitches(pitches_df, roster.resolve_ids(r, people), "pid")
    cov = {x["first"]: (x["n_pitches"], x["succeeded"]) for x in roster.roster_coverage(r, tagged).collect()}
    assert cov == {"A": (2, True), "C": (0, False), "X": (0, False)}
    assert {x["first"] for x in roster.missing_pitchers(r, tagged).collect()} == {"C", "X"}
    with pytest.raises(ValueError):
        roster.require_any(tagged.limit(0))


def test_roster_first_match_with_a_null_id_is_skipped(spark):
    people = spark.createDataFrame([("A", "B", 1, None), ("A", "B", 2, 7), ("C", "D", 1, 4), ("C", "D", 2, None)],
                                   "name_first string, name_last string, pos int, player_id long")
    r = roster.roster_frame(spark, [{"first": "A", "last": "B"}, {"first": "C", "last": "D"}])
    assert {(x["first"], x["player_id"]) for x in roster.resolve_ids(r, people, order_col="pos").collect()} == {("C", 4)}


def test_numbers_from_text_and_nan(spark):
    df = spark.createDataFrame([("1",), (" -2.5e1 ",), ("NaN",), ("1d",), ("Infinity",), ("",), (None,), (".5",)], "t string")
    assert [r[0] for r in df.select(features.coerce_numeric(F.col("t"), text=True)).collect()] == [1.0, -25.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.5]
    nan = spark.createDataFrame([(NAN,), (None,), (2.0,)], "v double")
    assert [r[0] for r in nan.select(features.coerce_numeric(F.col("v"))).collect()] == [0.0, 0.0, 2.0]


def test_absent_and_nan_columns_when_serving(spark):
    st = features.FeatureState(["plate_x", "dist_to_zone_center"], {"plate_x": 0.5, "dist_to_zone_center": 9.0}, ["stand"], {"stand": ["L", "R", "Unknown"]})
    scen = spark.createDataFrame([(NAN, 2.0, 3.5, 1.5)], "plate_x double, plate_z double, sz_top double, sz_bot double")
    row = features.featurize_with_state(scen, st).first()
    assert row["plate_x"] == 0.5 and row["dist_to_zone_center"] == 0.0
    assert row["stand_Unknown"] == 1.0 and row["stand_R"] == 0.0  # an absent column counts as missing values


def test_count_matrix_with_any_values(spark):
    df = spark.createDataFrame([(0, 1.0, 1), (0, 1.5, 0), (1, 1.0, 0)], "balls int, strikes double, is_strike int")
    got = {r["balls"]: (r["strikes_1.0"], r["strikes_1.5"]) for r in summaries.count_matrix(df).collect()}
    assert got == {0: (1.0, 0.0), 1: (0.0, 0.0)}
    assert summaries.count_matrix(df, values=[1.5]).columns == ["balls", "strikes_1.5"]


def test_available_features_and_preview(spark):
    df = spark.createDataFrame([(1, 2)] * 9, "a int, b int")
    with pytest.warns(UserWarning, match="zz"):
        assert prep.available_features(df, ["b", "zz"]) == ["b"]
    assert prep.preview(df, 3).count() == 3
    assert [r[0] for r in summaries.filter_options(df, "b").collect()] == [2]


def test_ordered_outputs_come_in_order(spark):
    df = spark.createDataFrame([(i % 4, i % 3, "abcd"[i % 4], int(i % 5 == 0)) for i in range(200)], "balls int, strikes int, t string, is_strike int")
    rates = [(r["strike_rate"], r["t"]) for r in summaries.rate_by(df, "t").collect()]
    assert rates == sorted(rates, key=lambda x: (-x[0], x[1]))
    counts = [(r["balls"], r["strikes"]) for r in summaries.rate_by_count(df).collect()]
    assert counts == sorted(counts)
    labels = [(r["balls_sort"], r["strikes_sort"]) for r in summaries.rate_by_count_label(df).collect()]
    assert labels == sorted(labels)
    assert [r["balls"] for r in summaries.count_matrix(df).collect()] == [0, 1, 2, 3]
    n = [(r["n"], r["t"]) for r in summaries.value_counts(df, "t").collect()]
    assert n == sorted(n, key=lambda x: (-x[0], x[1]))


def test_histogram_has_no_class_shuffle(spark):
    df = spark.createDataFrame([(1, 90.0), (0, 80.0)], "is_strike int, release_speed double")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = zones.speed_histogram(df)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_forest_depth_is_checked():
    with pytest.raises(ValueError, match="at most 30"):
        from zonecast.operators import models
        models.make_estimator("random_forest", max_depth=31)


def test_union_by_name_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    b = spark.createDataFrame([(2, 1.5)], "id int, v double")
    out = {r["id"]: (r["s"], r["v"]) for r in roster.union_sources([a, b]).collect()}
    assert out == {1: ("x", None), 2: (None, 1.5)}


def test_required_columns_error(spark):
    with pytest.raises(ValueError, match="lacks required columns"):
        S.require_columns(spark.createDataFrame([(1,)], "description int"), S.REQUIRED_COLUMNS)
