"""Registered queries that combine tables in time or answer many slices from one pass, with their DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from zonecast import schema as S
from zonecast.operators import cube, diff, distinct, evaluation, features, intervals, models, ordered, prep, sketches, split
from zonecast.plans.oracle import _GRID, _SPLIT, with_base
from zonecast.session import settled
from zonecast.sources.fixture import KEY_COLUMNS
from zonecast.sources.fixture import pitch_view

STRETCH = 80  # the events' month laid over the years of the pitches
CUBE_DIMS = ["pitch_type", "stand", "p_throws", "balls", "strikes"]


def _clean(spark, d):
    return prep.basic_cleaning(prep.label_outcomes(pitch_view(spark, d)))


def _events(spark, d):
    return spark.read.parquet(f"{d}/events.parquet")


def q_asof_last_pitch(spark, d):
    """The last pitch of the user's number before each event; pitches of one day in order of their keys."""
    ev = _events(spark, d).select("event_id", "user_id", F.expr(f"date'1995-01-01' + cast(floor(unix_micros(cast(ts as timestamp)) / 1000000 - 1704067200) * {STRETCH} / 86400 as int)").alias("on_day"))
    p = _clean(spark, d).select("l_suppkey", "game_date", "l_orderkey", "l_partkey", "l_linenumber", "pitch_type", "is_strike")
    return ordered.asof_join(ev, p, "on_day", "game_date", ["user_id"], ["l_suppkey"], ties=["l_orderkey", "l_partkey", "l_linenumber"], prefix="p_")


def q_asof_last_purchase(spark, d):
    """The user's last purchase before each error, within two days."""
    e = _events(spark, d)
    return ordered.asof_join(e.where("event_type = 'error'").select("event_id", "user_id", "ts"), e.where("event_type = 'purchase'").select("event_id", "user_id", "ts", "value"),
                             "ts", "ts", ["user_id"], ["user_id"], ties=["event_id"], allow_equal=False, tolerance=F.expr("interval 2 days"), prefix="last_").drop("last_user_id")


def q_asof_next_purchase(spark, d):
    """The user's next purchase at or after each signup."""
    e = _events(spark, d)
    return ordered.asof_join(e.where("event_type = 'signup'").select("event_id", "user_id", "ts"), e.where("event_type = 'purchase'").select("event_id", "user_id", "ts"),
                             "ts", "ts", ["user_id"], ["user_id"], ties=["event_id"], direction="forward", prefix="next_").drop("next_user_id")


def q_rolling_strike_rate(spark, d):
    """Strikes in the last 50 pitches of each pitcher."""
    keys = ["l_suppkey", "game_date", "l_orderkey", "l_partkey", "l_linenumber"]
    out = ordered.rolling(_clean(spark, d).select(*keys, "is_strike"), keys[:1], keys[1:], 50, {"n_last": F.count("is_strike"), "n_strikes": F.sum("is_strike")})
    return out.select(*keys, "n_last", "n_strikes", (F.col("n_strikes") / F.col("n_last")).alias("strike_rate"))


def q_rolling_value(spark, d):
    """Smallest and largest value of the last 20 events of a type (five types, so each is a hot key)."""
    e = _events(spark, d).select("event_id", "event_type", "ts", "value")
    return ordered.rolling(e, ["event_type"], ["ts", "event_id"], 20, {"least": F.min("value"), "most": F.max("value"), "n_last": F.count("event_id")})


def q_interval_errors_after_purchase(spark, d):
    """Errors of a user within six hours after a purchase."""
    e = _events(spark, d)
    after = e.where("event_type = 'purchase'").select(F.col("event_id").alias("purchase_id"), "user_id", "ts", (F.col("ts") + F.expr("interval 6 hours")).alias("until"))
    got = intervals.interval_join(e.where("event_type = 'error'").select("event_id", "user_id", "ts"), after, "ts", ["ts", "until"], ["user_id"], ["user_id"], closed="left")
    return got.select("event_id", "user_id", F.col("right_purchase_id").alias("purchase_id"))


def q_interval_overlaps(spark, d):
    """Overlapping minutes of signups and purchases of whichever user; a purchase lasts its value in seconds."""
    e = _events(spark, d).where("value is not null")
    s = e.where("event_type = 'signup'").select(F.col("event_id").alias("signup_id"), "ts", (F.col("ts") + F.expr("interval 1 minute")).alias("until"))
    p = e.where("event_type = 'purchase'").select(F.col("event_id").alias("purchase_id"), "ts", (F.col("ts") + F.make_interval(secs=F.floor("value").cast("decimal(18,6)"))).alias("until"))
    return intervals.interval_join(s, p, ["ts", "until"], ["ts", "until"]).select("signup_id", F.col("right_purchase_id").alias("purchase_id"))


def _cells(spark, d):
    return cube.dashboard_cells(_clean(spark, d))


def q_slice_cube(spark, d):
    return cube.slice_cube(_cells(spark, d), CUBE_DIMS)


def q_slice_sets(spark, d):
    return cube.chosen_slices(_cells(spark, d), [["pitch_type"], ["balls", "strikes"], ["pitch_type", "stand"], []])


def q_cells_zone_grid(spark, d):
    """The 3 x 3 grid of a slice, from cells."""
    return cube.zone_grid_scaled(prep.filter_slice(_cells(spark, d), pitch_type="SL", stand="R"), "prob", 5)


def q_cells_rate_by_pitch_type(spark, d):
    return cube.rate_by(prep.filter_slice(_cells(spark, d), balls=1), "pitch_type")


def q_distinct_users(spark, d):
    """Distinct users per type and day, per type and in all, from one table of bitmaps."""
    e = _events(spark, d).select("event_type", F.to_date("ts").alias("day"), "user_id")
    bits = settled(distinct.id_bitmaps(e, ["event_type", "day"], "user_id"), "user-bitmaps")
    levels = [distinct.distinct_counts(bits, dims, "n_users") for dims in (["event_type", "day"], ["event_type"], [])]
    out = levels[0].unionByName(levels[1], allowMissingColumns=True).unionByName(levels[2], allowMissingColumns=True)
    return out.select("event_type", "day", "n_users")


def _versions(spark, d):
    """A pitch table and its next version: some speeds corrected, some orders gone, some rows twice."""
    old = _clean(spark, d).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "game_date", "pitch_type", "release_speed", "is_strike")
    new = old.where("l_orderkey % 40 <> 0").withColumn("release_speed", F.expr("if(l_partkey % 50 = 0, release_speed + 0.5, release_speed)"))
    return old.where("l_orderkey % 37 <> 1"), new.unionByName(new.where("l_partkey % 75 = 0"))


def q_table_diff(spark, d):
    return diff.row_diff(*_versions(spark, d))


def q_table_diff_by_key(spark, d):
    """By order, which has several rows."""
    return diff.keyed_diff(*_versions(spark, d), ["l_orderkey"])


def q_sketch_quantiles(spark, d):
    """Sketches per type and day, merged per type: whether the true rank of each answer is within the stated error."""
    e = _events(spark, d).select("event_type", F.to_date("ts").alias("day"), "value")
    daily = sketches.quantile_sketches(e, ["event_type", "day"], "value")
    got = sketches.sketch_quantiles(sketches.merged_sketches(daily, ["event_type"]), [0.05, 0.25, 0.5, 0.75, 0.95])
    ranks = got.join(e.where("value is not null"), "event_type").groupBy("event_type", "n", "prob", "quantile").agg(
        (F.count_if(F.col("value") < F.col("quantile")) / F.col("n")).alias("low"), (F.count_if(F.col("value") <= F.col("quantile")) / F.col("n")).alias("high"))
    slack = 2 * sketches.rank_error()  # the stated error holds in 99 of 100 cases; twice it in all but a few in a million
    return ranks.select("event_type", "n", "prob", ((F.col("low") - slack <= F.col("prob")) & (F.col("prob") <= F.col("high") + slack)).alias("within_error"))


def q_stream_windowed_rates(spark, d):
    """The events as a stream: hourly counts and large values per type, of windows that are over two hours before the last event."""
    from zonecast.session import shared_path
    from zonecast.streaming.summaries import start_windowed_rates

    # a pattern, as a stream can't name a single file
    out = shared_path(spark, f"stream-rates-{uuid.uuid4().hex}")
    made = lambda df: df.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", (F.col("value") > 100).cast("int").alias("large"))
    q = start_windowed_rates(spark, f"{d}/events.parque[t]", out, _events(spark, d).schema, key_cols=["event_id"], time_col="ts", by=["event_type"], label_col="large",
                             max_files_per_trigger=1_000_000, prepare=made)
    q.awaitTermination()
    rates = spark.read.parquet(out)
    return rates.select("event_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"), F.col("window_end").cast("timestamp_ntz").alias("window_end"), "n_rows", F.col("n_strikes").alias("n_large"))


AUC_FLOOR = {"logistic_regression": 0.70, "random_forest": 0.78, "boosted_trees": 0.78}


def _fitted(spark, d, name):
    """One row about a model fitted at its full size: what SQL can count, and whether it learnt."""
    rows = settled(split.stratified_split(_clean(spark, d), KEY_COLUMNS, "is_strike", 0.2, 42), "split-rows")
    st = features.fit_state(rows)
    train = features.transform(rows.filter("split = 'train'"), st, keep=["is_strike"])
    test = features.transform(rows.filter("split = 'test'"), st, keep=KEY_COLUMNS + ["is_strike"])
    model = models.fit_model(train, st, name)
    scores = settled(models.score(model, test, st, name, KEY_COLUMNS), "scores")
    count = lambda c: F.count_if(c)
    y, p, v = F.col("label"), F.col("prediction"), F.col("score")
    one = scores.groupBy("model").agg(
        F.count(F.lit(1)).alias("n_rows"), count(y == 1).alias("n_strikes"), count((y == p) | (y != p)).alias("n_in_confusion"),
        count(v.between(0, 1)).alias("n_probabilities"), count(p == (v > 0.5).cast("int")).alias("n_calls_by_score"))
    auc = evaluation.roc_auc(scores).select(F.col("model"), (F.col("roc_auc") >= AUC_FLOOR[name]).alias("learnt"))
    imp = models.feature_importance(model, st)
    top = [r["importance"] for r in models.top_importances(imp, 20).collect()]
    n, total, negative = imp.agg(F.count(F.lit(1)), F.sum("importance"), F.count_if(F.col("importance") < 0)).first()
    tree = name != "logistic_regression"
    return one.join(auc, "model").select(
        "*", F.lit(n).alias("n_features"), F.lit(len(top)).cast("long").alias("n_top"), F.lit(top == sorted(top, reverse=True) and negative == 0).alias("top_falls"),
        F.lit(round(total, 6) if tree else None).cast("double").alias("importance_sum"))


def q_logistic_model(spark, d):
    return _fitted(spark, d, "logistic_regression")


def q_forest_model(spark, d):
    """200 trees."""
    return _fitted(spark, d, "random_forest")


def q_boosted_model(spark, d):
    """200 rounds of depth 6."""
    return _fitted(spark, d, "boosted_trees")


QUERIES = {name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_") and callable(fn)}

_DAY = f"date '1995-01-01' + cast(floor(floor(epoch(ts) - 1704067200) * {STRETCH} / 86400) as int)"
_DIMS = ", ".join(CUBE_DIMS)
_OLD = "select l_orderkey, l_partkey, l_suppkey, l_linenumber, game_date, pitch_type, release_speed, is_strike from clean"
_VERSIONS = f"""base as ({_OLD}), old as (select * from base where l_orderkey % 37 <> 1),
 changed as (select * replace (if(l_partkey % 50 = 0, release_speed + 0.5, release_speed) as release_speed) from base where l_orderkey % 40 <> 0),
 new as (select * from changed union all select * from changed where l_partkey % 75 = 0)"""
SQL = {
    "asof_last_pitch": with_base(f"""select e.*, p.l_suppkey as p_l_suppkey, p.game_date as p_game_date, p.l_orderkey as p_l_orderkey, p.l_partkey as p_l_partkey,
  p.l_linenumber as p_l_linenumber, p.pitch_type as p_pitch_type, p.is_strike as p_is_strike
from (select event_id, user_id, {_DAY} as on_day from events) e asof left join last p on e.user_id = p.l_suppkey and e.on_day >= p.game_date""",
        extra="last as (select * from clean qualify row_number() over (partition by l_suppkey, game_date order by l_orderkey desc, l_partkey desc, l_linenumber desc) = 1)"),
    "asof_last_purchase": """select e.event_id, e.user_id, e.ts, case when ok then p.event_id end as last_event_id, case when ok then p.ts end as last_ts, case when ok then p.value end as last_value
from (select e.event_id, e.user_id, e.ts, p.event_id as pid, p.ts >= e.ts - interval 2 days as ok from (select * from events where event_type = 'error') e
  asof left join (select * from events where event_type = 'purchase' qualify row_number() over (partition by user_id, ts order by event_id desc) = 1) p on e.user_id = p.user_id and e.ts > p.ts) e
left join events p on p.event_id = e.pid""",
    "asof_next_purchase": """select e.event_id, e.user_id, e.ts, p.event_id as next_event_id, p.ts as next_ts from (select * from events where event_type = 'signup') e
  asof left join (select * from events where event_type = 'purchase' qualify row_number() over (partition by user_id, ts order by event_id) = 1) p on e.user_id = p.user_id and e.ts <= p.ts""",
    "rolling_strike_rate": with_base("""select l_suppkey, game_date, l_orderkey, l_partkey, l_linenumber, n_last, n_strikes, cast(n_strikes as double) / n_last as strike_rate from (
 select *, count(is_strike) over w as n_last, cast(sum(is_strike) over w as bigint) as n_strikes from clean
 window w as (partition by l_suppkey order by game_date, l_orderkey, l_partkey, l_linenumber rows between 49 preceding and current row))"""),
    "rolling_value": """select event_id, event_type, ts, value, min(value) over w as least, max(value) over w as most, count(event_id) over w as n_last from events
 window w as (partition by event_type order by ts, event_id rows between 19 preceding and current row)""",
    "interval_errors_after_purchase": """select e.event_id, e.user_id, p.event_id as purchase_id from events e join events p
 on e.user_id = p.user_id and e.ts >= p.ts and e.ts < p.ts + interval 6 hours where e.event_type = 'error' and p.event_type = 'purchase'""",
    "interval_overlaps": """select s.event_id as signup_id, p.event_id as purchase_id from events s join events p
 on s.ts <= p.ts + to_seconds(cast(floor(p.value) as bigint)) and p.ts <= s.ts + interval 1 minute and floor(p.value) >= 0
 where s.event_type = 'signup' and p.event_type = 'purchase' and s.value is not null and p.value is not null""",
    "slice_cube": with_base(f"select {_DIMS}, grouping({_DIMS}) as slice_id, count(*) as n_pitches, cast(sum(is_strike) as bigint) as n_strikes, avg(is_strike) as strike_rate from clean group by cube ({_DIMS})"),
    "slice_sets": with_base("""select pitch_type, balls, strikes, stand, grouping(pitch_type, balls, strikes, stand) as slice_id, count(*) as n_pitches, cast(sum(is_strike) as bigint) as n_strikes,
 avg(is_strike) as strike_rate from clean group by grouping sets ((pitch_type), (balls, strikes), (pitch_type, stand), ())"""),
    "cells_zone_grid": with_base("select zone, x_zone, z_zone, n_pitches, p as value, p as scaled from full_grid", extra=_GRID.replace("from clean", "from (select * from clean where pitch_type = 'SL' and stand = 'R')")),
    "cells_rate_by_pitch_type": with_base("select pitch_type, count(*) as n_pitches, avg(is_strike) as strike_rate from clean where balls = 1 and pitch_type is not null group by 1"),
    "distinct_users": """select event_type, cast(ts as date) as day, count(distinct user_id) as n_users from events group by 1, 2
 union all select event_type, null, count(distinct user_id) from events group by 1 union all select null, null, count(distinct user_id) from events""",
    "table_diff": with_base("""select *, 'added' as change, count(*) as n_rows from (select * from new except all select * from old) group by all
 union all select *, 'removed' as change, count(*) as n_rows from (select * from old except all select * from new) group by all""", extra=_VERSIONS),
    "table_diff_by_key": with_base("""select l_orderkey, case when o = 0 then 'added' when n = 0 then 'removed' else 'changed' end as change, o as n_old, n as n_new from
 (select l_orderkey, count(*) filter (where side = 0) as o, count(*) filter (where side = 1) as n from (select l_orderkey, 0 as side from old union all select l_orderkey, 1 from new) group by 1)
 where l_orderkey in (select l_orderkey from (select * from new except all select * from old) union all select l_orderkey from (select * from old except all select * from new))""", extra=_VERSIONS),
    "stream_windowed_rates": """select event_type, time_bucket(interval 1 hour, ts) as window_start, time_bucket(interval 1 hour, ts) + interval 1 hour as window_end, count(*) as n_rows,
 cast(sum(cast(value > 100 as int)) as bigint) as n_large from events where ts is not null group by 1, 2 having window_end <= (select max(ts) from events) - interval 2 hours""",
    "sketch_quantiles": "select event_type, count(value) as n, unnest([0.05, 0.25, 0.5, 0.75, 0.95])::double as prob, true as within_error from events group by 1",
}


def _model_sql(name: str) -> str:
    dummies = " + ".join(f"(select count(distinct coalesce({c}, 'Unknown')) - 1 from split_rows)" for c in S.CATEGORICAL_FEATURES)
    n = f"({len(S.NUMERIC_CONTEXT) + len(S.NUMERIC_PITCH) + len(S.ENGINEERED_FEATURES)} + {dummies})"
    return with_base(f"""select '{name}' as model, count(*) as n_rows, count(*) filter (where is_strike = 1) as n_strikes, count(*) as n_in_confusion, count(*) as n_probabilities,
 count(*) as n_calls_by_score, true as learnt, {n} as n_features, least(20, {n}) as n_top, true as top_falls, {'cast(null as double)' if name == 'logistic_regression' else 'cast(1 as double)'} as importance_sum
from split_rows where split = 'test'""", extra=_SPLIT)


SQL |= {"logistic_model": _model_sql("logistic_regression"), "forest_model": _model_sql("random_forest"), "boosted_model": _model_sql("boosted_trees")}
