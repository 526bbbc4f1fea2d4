"""Registered queries: each is ``f(spark, sf_dir) -> DataFrame`` over the driver tables.

Pitches are derived from ``lineitem`` (see ``zonecast.sources.fixture``); every
query runs over the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.operators import prep, summaries
from zonecast.sources.fixture import pitch_view

R6 = 6  # digits kept for order-dependent floating aggregates (sums/avgs of doubles, std)


def _raw(spark: SparkSession, d: str) -> DataFrame:
    return pitch_view(spark, d)


def _labeled(spark, d):
    return prep.label_outcomes(_raw(spark, d))


def _clean(spark, d):
    return prep.basic_cleaning(_labeled(spark, d))


def q_label_outcomes(spark, d):
    return _labeled(spark, d)


def q_label_audit(spark, d):
    return prep.label_audit(_raw(spark, d))


def q_speed_bounds(spark, d):
    return prep.speed_bounds(_labeled(spark, d))


def q_drop_missing_critical(spark, d):
    return prep.drop_missing_critical(_labeled(spark, d))


def q_prepare_dataset(spark, d):
    return _clean(spark, d)


def q_cleaning_audit(spark, d):
    return prep.cleaning_audit(_labeled(spark, d))


def q_filter_multiselect(spark, d):
    df = prep.derive_name(_clean(spark, d).join(
        spark.read.parquet(f"{d}/supplier.parquet").select(
            F.col("s_suppkey").alias("l_suppkey"), F.split("s_name", "#").getItem(0).alias("pitcher_first"),
            F.split("s_name", "#").getItem(1).alias("pitcher_last")),
        on="l_suppkey", how="left"))
    return prep.filter_multiselect(df, ["FF", "SL", "CU"],
                                   ["Supplier 000000001", "Supplier 000000004", "Supplier 000000009"])


def q_filter_slice(spark, d):
    return prep.filter_slice(_clean(spark, d), pitcher_name="All", pitch_type="SL", balls=1,
                             strikes="All", stand="R", p_throws="All")


def q_min_rows_gate(spark, d):
    return prep.min_rows_gate(prep.filter_slice(_clean(spark, d), pitch_type="FF", balls=3, strikes=2), 10)


def q_date_range_scan(spark, d):
    return prep.date_range(_clean(spark, d), "1996-01-01", "1996-12-31").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "game_date", "is_strike")


def q_derive_name(spark, d):
    sup = spark.read.parquet(f"{d}/supplier.parquet").select(
        F.col("s_suppkey").alias("l_suppkey"),
        F.when(F.col("s_suppkey") % 7 == 0, F.lit(None)).otherwise(F.split("s_name", "#").getItem(0)).alias("pitcher_first"),
        F.split("s_name", "#").getItem(1).alias("pitcher_last"))
    df = _clean(spark, d).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "game_date")
    return prep.derive_name(df.join(sup, on="l_suppkey", how="inner"))


def q_dataset_shape(spark, d):
    return prep.dataset_shape(_clean(spark, d))


def q_overview_totals(spark, d):
    return summaries.overview_totals(_clean(spark, d))


def q_rate_by_pitch_type(spark, d):
    return summaries.rate_by(_clean(spark, d), "pitch_type")


def q_rate_by_stance(spark, d):
    return summaries.rate_by(_clean(spark, d), "stand", digits=3)


def q_rate_by_count(spark, d):
    return summaries.rate_by_count(_clean(spark, d))


def q_rate_by_count_label(spark, d):
    return summaries.rate_by_count_label(_clean(spark, d))


def q_count_matrix(spark, d):
    return summaries.count_matrix(_clean(spark, d))


def q_value_counts(spark, d):
    return summaries.value_counts(_labeled(spark, d), "pitch_type")


def q_missing_profile(spark, d):
    return summaries.missing_profile(_labeled(spark, d))


def q_describe_by_class(spark, d):
    out = summaries.describe_by_class(_clean(spark, d), "release_speed", "is_strike")
    return out.select("is_strike", "count", *[F.round(c, R6).alias(c) for c in
                                              ["mean", "std", "min", "q25", "q50", "q75", "max"]])


def q_filter_options(spark, d):
    return summaries.filter_options_all(_clean(spark, d), ["pitch_type", "stand", "p_throws", "balls", "strikes"])


def q_median_profile(spark, d):
    from zonecast import schema as S
    out = summaries.median_profile(_clean(spark, d), S.NUMERIC_CONTEXT + S.NUMERIC_PITCH)
    return out.select("column", F.round("median", R6).alias("median"))


def q_slice_summary(spark, d):
    out = summaries.slice_summary(prep.filter_slice(_clean(spark, d), pitch_type="CH"))
    return out.select("n_pitches", "strike_rate", F.round("avg_release_speed", R6).alias("avg_release_speed"))



# --- zones and bins ---------------------------------------------------------
from zonecast.operators import zones  # noqa: E402

HEATMAP_BINS = 25


def q_zone_heatmap(spark, d):
    return zones.zone_heatmap(_clean(spark, d), HEATMAP_BINS)


def q_zone_heatmap_dense(spark, d):
    return zones.zone_heatmap_dense(_clean(spark, d), HEATMAP_BINS)


def q_zone_grid_count(spark, d):
    return zones.zone_grid(_clean(spark, d), "count")


def q_zone_grid_prob(spark, d):
    return zones.zone_grid(_clean(spark, d), "prob")


def q_zone_grid_scaled(spark, d):
    return zones.zone_grid_scaled(_clean(spark, d), "count")


def q_speed_histogram(spark, d):
    return zones.speed_histogram(_clean(spark, d), "release_speed", "is_strike", 30)



# --- features -----------------------------------------------------------------
from zonecast import schema as S  # noqa: E402
from zonecast.operators import evaluation, features, models, split  # noqa: E402
from zonecast.session import settled  # noqa: E402
from zonecast.sources.fixture import KEY_COLUMNS as KEYS  # noqa: E402


def _state(spark, d):
    return features.fit_state(_clean(spark, d))


def _round(cols, digits=R6):
    return [F.round(F.col(c), digits).alias(c) for c in cols]


def q_zone_geometry(spark, d):
    return features.add_engineered(_clean(spark, d)).select(*KEYS, "zone_mid", "dist_to_zone_center")


def q_impute_median(spark, d):
    st = _state(spark, d)
    return features.impute_median(_clean(spark, d), st).select(*KEYS, *_round(st.numeric))


def q_fill_unknown(spark, d):
    return features.fill_unknown(_clean(spark, d)).select(*KEYS, *S.CATEGORICAL_FEATURES)


def q_one_hot(spark, d):
    st = _state(spark, d)
    return _clean(spark, d).select(*KEYS, *features.one_hot_exprs(st))


def q_coerce_numeric(spark, d):
    c = _clean(spark, d)
    return c.select(*KEYS, features.coerce_numeric(F.col("balls").cast("string")).alias("balls_num"),
                    features.coerce_numeric(F.col("pitch_type")).alias("pitch_type_num"),
                    features.coerce_numeric(F.col("on_1b").cast("string")).alias("on_1b_num"))


def q_feature_matrix(spark, d):
    st = _state(spark, d)
    fm = features.transform(_clean(spark, d), st, keep=KEYS + ["is_strike"])
    return fm.select(*KEYS, "is_strike", *_round(st.feature_names()))


def _scenarios(spark, d):
    """What-if scenario rows derived from the cleaned table: sz_top absent, some
    locations missing, some pitch types unseen by the fit."""
    c = _clean(spark, d)
    return c.select(*KEYS, "balls", "strikes", "outs_when_up", "on_1b", "on_2b", "on_3b", "release_speed",
                    "pfx_x", "pfx_z", F.when(F.col("l_orderkey") % 7 == 0, F.lit(None)).otherwise(F.col("plate_x")).alias("plate_x"),
                    "plate_z", "sz_bot",
                    F.when(F.col("l_partkey") % 13 == 0, F.lit("KN")).otherwise(F.col("pitch_type")).alias("pitch_type"),
                    "stand", "p_throws", "inning_topbot")


def q_featurize_with_state(spark, d):
    st = _state(spark, d)
    fm = features.featurize_with_state(_scenarios(spark, d), st, keep=KEYS)
    return fm.select(*KEYS, *_round(st.feature_names()))


# --- split, scoring and evaluation ------------------------------------------------

def _split(spark, d):
    return split.stratified_split(_clean(spark, d), KEYS, "is_strike", 0.2, 42)


def q_stratified_split(spark, d):
    return _split(spark, d).select(*KEYS, "is_strike", "split")


def q_split_balance(spark, d):
    return summaries.split_balance(_split(spark, d))


def q_baseline_predict(spark, d):
    s = _split(spark, d)
    return models.baseline_scores(s.filter("split = 'train'"), s.filter("split = 'test'"), KEYS)


def _rule_scores(df):
    """Fixed distance rule used to exercise the evaluators with SQL-checkable scores."""
    e = features.add_engineered(df)
    sc = F.lit(1.0) / (F.lit(1.0) + F.floor(F.lit(4.0) * F.coalesce(F.col("dist_to_zone_center"), F.lit(100.0))))
    return e.select(*KEYS, F.lit("zone_rule").alias("model"), F.col("is_strike").alias("label"),
                    F.when(sc >= 0.5, 1).otherwise(0).alias("prediction"), sc.alias("score"))


def _long_predictions(spark, d):
    s = _split(spark, d)
    test, train = s.filter("split = 'test'"), s.filter("split = 'train'")
    return models.baseline_scores(train, test, KEYS).unionByName(_rule_scores(test))


def q_score_bands(spark, d):
    return models.score_bands(_rule_scores(_clean(spark, d))).select(*KEYS, "score", "call", "band")


def q_classification_metrics(spark, d):
    return evaluation.classification_metrics(_long_predictions(spark, d))


def q_roc_auc(spark, d):
    out = evaluation.roc_auc(_long_predictions(spark, d))
    return out.select("model", F.round("roc_auc", R6).alias("roc_auc"), "n_pos", "n_neg")


def q_roc_curve(spark, d):
    return evaluation.roc_curve(_long_predictions(spark, d))


def q_metrics_by_model(spark, d):
    out = evaluation.metrics_by_model(_long_predictions(spark, d))
    return out.select("model", *_round(["accuracy", "precision", "recall", "f1", "roc_auc"]))


# Fitted models have no SQL equivalent.  Each is fitted at the operator's full size, with no parameter set here.

def _model_scores(spark, d, name):
    s = settled(_split(spark, d), "split-rows")  # read for the medians, the categories, the fit and the scores
    st = features.fit_state(s)
    fm_train = features.transform(s.filter("split = 'train'"), st, keep=["is_strike"])
    fm_test = features.transform(s.filter("split = 'test'"), st, keep=KEYS + ["is_strike"])
    model = models.fit_model(fm_train, st, name)
    return model, st, models.score(model, fm_test, st, name, KEYS)


def q_logistic_scores(spark, d):
    return _model_scores(spark, d, "logistic_regression")[2]


def q_forest_scores(spark, d):
    return _model_scores(spark, d, "random_forest")[2]


def q_boosted_scores(spark, d):
    return _model_scores(spark, d, "boosted_trees")[2]


def q_feature_importance(spark, d):
    model, st, _ = _model_scores(spark, d, "random_forest")
    return models.feature_importance(model, st)


def q_top_importances(spark, d):
    model, st, _ = _model_scores(spark, d, "logistic_regression")
    return models.top_importances(models.feature_importance(model, st), 20)



# --- roster lookups and unions -------------------------------------------------------
from zonecast.operators import roster as R  # noqa: E402

# Roster over the driver's part names ("adjective noun" -> first, last); several
# names repeat in part (first match = smallest key) and the last one is absent.
FIXTURE_ROSTER = [
    {"first": "red", "last": "plate", "throws": "R"},
    {"first": "small", "last": "widget", "throws": "R"},
    {"first": "hot", "last": "plate", "throws": "L"},
    {"first": "large", "last": "rod", "handedness": "L"},
    {"first": "blue", "last": "bolt", "throws": "", "handedness": "R"},
    {"first": "purple", "last": "unicorn", "throws": "R"},
]


def _people(spark, d):
    part = spark.read.parquet(f"{d}/part.parquet")
    name = F.split("p_name", " ")
    return part.select(name.getItem(0).alias("name_first"), name.getItem(1).alias("name_last"),
                       F.col("p_partkey").alias("player_id"))


def _tagged(spark, d):
    roster = R.roster_frame(spark, FIXTURE_ROSTER)
    ids = R.resolve_ids(roster, _people(spark, d))
    return roster, R.tag_pitches(_clean(spark, d), ids, "l_partkey")


def q_roster_join(spark, d):
    _, t = _tagged(spark, d)
    return t.select(*KEYS, "is_strike", "pitcher_first", "pitcher_last", "pitcher_name", "throws_config")


def q_roster_coverage(spark, d):
    roster, t = _tagged(spark, d)
    return R.roster_coverage(roster, t)


def q_union_sources(spark, d):
    _, t = _tagged(spark, d)
    right = t.filter(F.col("throws_config") == "R").select(*KEYS, "pitcher_name", "throws_config")
    left = t.filter(F.col("throws_config") != "R").select(*KEYS, "pitcher_name", "release_speed")
    return R.union_sources([right, left])


def q_tag_roster(spark, d):
    return prep.tag_constant(_clean(spark, d).select(*KEYS), "Gerrit", "Cole", "R")



# --- panel pieces that other queries use internally ---------------------------------

def q_axis_extents(spark, d):
    return summaries.axis_extents(_clean(spark, d))


def q_shown_vs_total(spark, d):
    df = _clean(spark, d)
    return prep.shown_vs_total(df, prep.multiselect_condition(df, ["FF", "CH", "ST"]))


def q_missing_pitchers(spark, d):
    roster, t = _tagged(spark, d)
    return R.missing_pitchers(roster, t)


def q_value_counts_by_target(spark, d):
    return summaries.value_counts(_clean(spark, d), "is_strike")


def q_value_counts_by_hand(spark, d):
    return summaries.value_counts(_clean(spark, d), "p_throws", by="value")



# --- the same operators on other tables (column names are parameters) -------------------

def _events(spark, d):
    return spark.read.parquet(f"{d}/events.parquet")


def q_events_value_counts(spark, d):
    return summaries.value_counts(_events(spark, d), "event_type")


def q_events_histogram(spark, d):
    return zones.speed_histogram(_events(spark, d), "value", "event_type", 30)


def q_events_describe(spark, d):
    out = summaries.describe_by_class(_events(spark, d), "value", "event_type")
    return out.select("event_type", "count", *[F.round(c, R6).alias(c) for c in
                                               ["mean", "std", "min", "q25", "q50", "q75", "max"]])


def q_orders_rate_by_priority(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet").withColumn(
        "is_filled", (F.col("o_orderstatus") == "F").cast("int"))
    return summaries.rate_by(o, "o_orderpriority", "is_filled")


def q_events_describe_by_user(spark, d):
    out = summaries.describe_by_class(_events(spark, d), "value", "user_id")
    return out.select("user_id", "count", *[F.round(c, R6).alias(c) for c in
                                            ["mean", "std", "min", "q25", "q50", "q75", "max"]])


def q_orders_median_by_customer(spark, d):
    from zonecast.operators.selection import exact_quantiles
    o = spark.read.parquet(f"{d}/orders.parquet")
    return exact_quantiles(o, "o_totalprice", [0.5], ["o_custkey"]).select(
        "o_custkey", "n", F.round("quantile", R6).alias("median"))


def _continuous_scores(spark, d):
    """A nearly unique score per row."""
    e = features.add_engineered(_clean(spark, d))
    sc = F.lit(1.0) / (F.lit(1.0) + F.coalesce(F.col("dist_to_zone_center"), F.lit(100.0)))
    return e.select(F.lit("distance").alias("model"), F.col("is_strike").alias("label"), sc.alias("score"))


def q_roc_auc_continuous(spark, d):
    out = evaluation.roc_auc(_continuous_scores(spark, d))
    return out.select("model", F.round("roc_auc", R6).alias("roc_auc"), "n_pos", "n_neg")


def q_roc_curve_continuous(spark, d):
    out = evaluation.roc_curve(_continuous_scores(spark, d))
    return out.select("model", *_round(["threshold", "fpr", "tpr"], 9))


def q_coerce_numeric_text(spark, d):
    e = _events(spark, d)
    return e.select("event_id", features.coerce_numeric(F.col("props"), text=True).alias("props_num"),
                    features.coerce_numeric(F.concat(F.col("user_id").cast("string"), F.lit("d")), text=True).alias("suffixed"),
                    features.coerce_numeric(F.col("user_id").cast("string"), text=True).alias("user_num"))


def q_roster_null_first(spark, d):
    """The first match of some names has a null id: those names are skipped."""
    people = _people(spark, d)
    order = F.col("player_id")
    nulled = people.select("name_first", "name_last", order.alias("pos"),
                           F.when(order % 3 == 0, F.lit(None)).otherwise(order).alias("player_id"))
    roster = R.roster_frame(spark, FIXTURE_ROSTER)
    return R.resolve_ids(roster, nulled, order_col="pos").select("first", "last", "player_id")


def q_logistic_score_counts(spark, d):
    """Scored rows per class: every test row once, with a probability."""
    s = q_logistic_scores(spark, d)
    return s.groupBy("model", "label").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("score").between(0, 1)).alias("n_probabilities"))


QUERIES = {name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_") and callable(fn)}
