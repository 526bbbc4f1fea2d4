"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark operators: plain SQL over the driver's
views (``lineitem``, ``supplier``, ``part`` ...).
"""

from __future__ import annotations

from zonecast import schema as S
from zonecast.sources.fixture import PITCH_VIEW_SQL


def _inlist(values):
    return ", ".join("'" + v + "'" for v in values)


CTE = {
    "raw_pitches": PITCH_VIEW_SQL,
    "labeled": f"""select * from (select *, case when description in ({_inlist(S.STRIKE_DESCRIPTIONS)}) then 1
        when description in ({_inlist(S.BALL_DESCRIPTIONS)}) then 0 end as is_strike from raw_pitches) t
        where is_strike is not null""",
    "clean": """select * from labeled where release_speed >= cast(60 as double) and release_speed <= cast(105 as double)
        and plate_x is not null and plate_z is not null and balls is not null and strikes is not null""",
}
ORDER = ["raw_pitches", "labeled", "clean"]


def with_base(body: str, upto: str = "clean", extra: str = "") -> str:
    names = ORDER[: ORDER.index(upto) + 1]
    ctes = ",\n".join(f"{n} as ({CTE[n]})" for n in names)
    if extra:
        ctes += ",\n" + extra
    return f"with {ctes}\n{body}"


SQL: dict[str, str] = {}

SQL["label_outcomes"] = with_base("select * from labeled", "labeled")
SQL["label_audit"] = with_base(f"""
select count(*) as n_input,
 count(*) filter (where description in ({_inlist(S.STRIKE_DESCRIPTIONS + S.BALL_DESCRIPTIONS)})) as n_kept,
 count(*) filter (where description in ({_inlist(S.STRIKE_DESCRIPTIONS)})) as n_strikes,
 count(*) filter (where description in ({_inlist(S.BALL_DESCRIPTIONS)})) as n_balls,
 count(*) filter (where description is null or description not in ({_inlist(S.STRIKE_DESCRIPTIONS + S.BALL_DESCRIPTIONS)})) as n_dropped
from raw_pitches""", "raw_pitches")
SQL["speed_bounds"] = with_base(
    "select * from labeled where release_speed >= cast(60 as double) and release_speed <= cast(105 as double)", "labeled")
SQL["drop_missing_critical"] = with_base(
    "select * from labeled where plate_x is not null and plate_z is not null and balls is not null and strikes is not null",
    "labeled")
SQL["prepare_dataset"] = with_base("select * from clean")
SQL["cleaning_audit"] = with_base("""
select step_order, step, count(*) as n_rows from (
 select case when not coalesce(release_speed >= cast(60 as double) and release_speed <= cast(105 as double), false) then 1
   when plate_x is null then 2 when plate_z is null then 3 when balls is null then 4 when strikes is null then 5
   when is_strike is null then 6 else 7 end as step_order,
  case when not coalesce(release_speed >= cast(60 as double) and release_speed <= cast(105 as double), false) then 'release_speed'
   when plate_x is null then 'plate_x' when plate_z is null then 'plate_z' when balls is null then 'balls'
   when strikes is null then 'strikes' when is_strike is null then 'is_strike' else 'kept' end as step
 from labeled) t group by step_order, step""", "labeled")
_SUP_NAMES = """sup as (select s_suppkey as l_suppkey, split_part(s_name, '#', 1) as pitcher_first,
 split_part(s_name, '#', 2) as pitcher_last from supplier)"""
SQL["filter_multiselect"] = with_base("""
select c.*, s.pitcher_first, s.pitcher_last, s.pitcher_first || ' ' || s.pitcher_last as pitcher_name
from clean c left join sup s on c.l_suppkey = s.l_suppkey
where c.pitch_type in ('FF', 'SL', 'CU')
 and s.pitcher_first || ' ' || s.pitcher_last in ('Supplier 000000001', 'Supplier 000000004', 'Supplier 000000009')""",
                                      extra=_SUP_NAMES)
SQL["filter_slice"] = with_base("select * from clean where pitch_type = 'SL' and balls = 1 and stand = 'R'")
SQL["min_rows_gate"] = with_base("""
select * from clean where pitch_type = 'FF' and balls = 3 and strikes = 2
 and (select count(*) from clean where pitch_type = 'FF' and balls = 3 and strikes = 2) >= 10""")
SQL["date_range_scan"] = with_base("""
select l_orderkey, l_partkey, l_suppkey, l_linenumber, game_date, is_strike from clean
where game_date between date '1996-01-01' and date '1996-12-31'""")
SQL["derive_name"] = with_base("""
select c.l_suppkey, c.l_orderkey, c.l_partkey, c.l_linenumber, c.game_date,
 case when s_suppkey % 7 = 0 then null else split_part(s_name, '#', 1) end as pitcher_first,
 split_part(s_name, '#', 2) as pitcher_last,
 (case when s_suppkey % 7 = 0 then null else split_part(s_name, '#', 1) end) || ' ' || split_part(s_name, '#', 2) as pitcher_name
from clean c join supplier s on c.l_suppkey = s.s_suppkey""")
SQL["dataset_shape"] = with_base("select count(*) as n_rows, 24 as n_cols from clean")
SQL["overview_totals"] = with_base("""
select count(*) as n_pitches, cast(sum(is_strike) as bigint) as n_strikes,
 cast(count(*) - sum(is_strike) as bigint) as n_balls, avg(is_strike) as strike_rate from clean""")
SQL["rate_by_pitch_type"] = with_base("""
select pitch_type, count(*) as n_pitches, avg(is_strike) as strike_rate from clean
where pitch_type is not null group by pitch_type""")
SQL["rate_by_stance"] = with_base("""
select stand, count(*) as n_pitches, round_even(avg(is_strike), 3) as strike_rate from clean
where stand is not null group by stand""")
SQL["rate_by_count"] = with_base("""
select balls, strikes, count(*) as total, cast(sum(is_strike) as bigint) as strikes_n,
 round_even(avg(is_strike), 3) as strike_rate from clean group by balls, strikes""")
SQL["rate_by_count_label"] = with_base("""
select count_label, n_pitches, strike_rate,
 cast(split_part(count_label, '-', 1) as int) as balls_sort, cast(split_part(count_label, '-', 2) as int) as strikes_sort
from (select cast(balls as varchar) || '-' || cast(strikes as varchar) as count_label, count(*) as n_pitches,
 avg(is_strike) as strike_rate from clean group by 1) t where n_pitches >= 10""")
SQL["count_matrix"] = with_base("""
select balls,
 coalesce(avg(is_strike) filter (where strikes = 0), 0) as strikes_0,
 coalesce(avg(is_strike) filter (where strikes = 1), 0) as strikes_1,
 coalesce(avg(is_strike) filter (where strikes = 2), 0) as strikes_2
from clean group by balls""")
SQL["value_counts"] = with_base(
    "select pitch_type, count(*) as n from labeled where pitch_type is not null group by pitch_type", "labeled")
SQL["missing_profile"] = with_base("""
select * from (
 unpivot (select
  count(*) filter (where l_orderkey is null) as l_orderkey, count(*) filter (where l_partkey is null) as l_partkey,
  count(*) filter (where l_suppkey is null) as l_suppkey, count(*) filter (where l_linenumber is null) as l_linenumber,
  count(*) filter (where game_date is null) as game_date, count(*) filter (where description is null) as description,
  count(*) filter (where release_speed is null or isnan(release_speed)) as release_speed,
  count(*) filter (where plate_x is null or isnan(plate_x)) as plate_x,
  count(*) filter (where plate_z is null or isnan(plate_z)) as plate_z,
  count(*) filter (where balls is null) as balls, count(*) filter (where strikes is null) as strikes,
  count(*) filter (where pitch_type is null) as pitch_type, count(*) filter (where stand is null) as stand,
  count(*) filter (where p_throws is null) as p_throws, count(*) filter (where inning_topbot is null) as inning_topbot,
  count(*) filter (where outs_when_up is null) as outs_when_up,
  count(*) filter (where on_1b is null or isnan(on_1b)) as on_1b, count(*) filter (where on_2b is null or isnan(on_2b)) as on_2b,
  count(*) filter (where on_3b is null or isnan(on_3b)) as on_3b,
  count(*) filter (where sz_top is null or isnan(sz_top)) as sz_top, count(*) filter (where sz_bot is null or isnan(sz_bot)) as sz_bot,
  count(*) filter (where pfx_x is null or isnan(pfx_x)) as pfx_x, count(*) filter (where pfx_z is null or isnan(pfx_z)) as pfx_z,
  count(*) filter (where is_strike is null) as is_strike
 from labeled) on columns(*) into name "column" value n_missing) where n_missing > 0""", "labeled")
SQL["describe_by_class"] = with_base("""
select is_strike, count(*) as count, round(avg(release_speed), 6) as mean, round(stddev_samp(release_speed), 6) as std,
 round(min(release_speed), 6) as min, round(quantile_cont(release_speed, 0.25), 6) as q25,
 round(quantile_cont(release_speed, 0.5), 6) as q50, round(quantile_cont(release_speed, 0.75), 6) as q75,
 round(max(release_speed), 6) as max
from clean where release_speed is not null group by is_strike""")
SQL["filter_options"] = with_base("""
select distinct "column", value from (
 select 'pitch_type' as "column", pitch_type as value from clean union all
 select 'stand', stand from clean union all select 'p_throws', p_throws from clean union all
 select 'balls', cast(balls as varchar) from clean union all select 'strikes', cast(strikes as varchar) from clean) t
where value is not null""")
_MED_COLS = S.NUMERIC_CONTEXT + S.NUMERIC_PITCH
SQL["median_profile"] = with_base(" union all ".join(
    f"select '{c}' as \"column\", round(median({c}), 6) as median from clean" for c in _MED_COLS))
SQL["slice_summary"] = with_base("""
select count(*) as n_pitches, avg(is_strike) as strike_rate, round(avg(release_speed), 6) as avg_release_speed
from clean where pitch_type = 'CH'""")

# --- zones and bins ---------------------------------------------------------
_HB = 25
_HEAT_CELLS = f"""
bnd as (select min(plate_x) as xlo, max(plate_x) as xhi, min(plate_z) as zlo, max(plate_z) as zhi from clean),
edg as (select list_transform(range(0, {_HB} + 1), lambda i: case when i = {_HB} then xhi else i * ((xhi - xlo) / {_HB}) + xlo end) as xe,
 list_transform(range(0, {_HB} + 1), lambda i: case when i = {_HB} then zhi else i * ((zhi - zlo) / {_HB}) + zlo end) as ze from bnd),
cells as (select x_bin, z_bin, count(*) as n_pitches, avg(is_strike) as strike_prob from (
 select cast(greatest(len(list_filter(xe, lambda w: w < plate_x)) - 1, 0) as int) as x_bin,
  cast(greatest(len(list_filter(ze, lambda w: w < plate_z)) - 1, 0) as int) as z_bin, is_strike
 from clean, edg where plate_x is not null and plate_z is not null) t group by x_bin, z_bin)"""
SQL["zone_heatmap"] = with_base("select * from cells", extra=_HEAT_CELLS)
SQL["zone_heatmap_dense"] = with_base("""
select xs.x_bin, zs.z_bin, coalesce(c.strike_prob, 0) as strike_prob
from (select distinct x_bin from cells) xs cross join (select distinct z_bin from cells) zs
left join cells c on c.x_bin = xs.x_bin and c.z_bin = zs.z_bin""", extra=_HEAT_CELLS)
_GRID = """
ge as (select list_transform(range(0, 4), lambda i: case when i = 3 then cast(0.83 as double) else i * ((cast(0.83 as double) - cast(-0.83 as double)) / 3) + cast(-0.83 as double) end) as xe,
 list_transform(range(0, 4), lambda i: case when i = 3 then cast(3.5 as double) else i * ((cast(3.5 as double) - cast(1.5 as double)) / 3) + cast(1.5 as double) end) as ze),
gz as (select x_zone, z_zone, count(*) as n_pitches, avg(is_strike) as p from (
 select case when plate_x between cast(-0.83 as double) and cast(0.83 as double) then cast(greatest(len(list_filter(xe, lambda w: w < plate_x)) - 1, 0) as int) end as x_zone,
  case when plate_z between cast(1.5 as double) and cast(3.5 as double) then cast(greatest(len(list_filter(ze, lambda w: w < plate_z)) - 1, 0) as int) end as z_zone,
  is_strike from clean, ge) t where x_zone is not null and z_zone is not null group by x_zone, z_zone),
grid as (select cast(x.i as int) as x_zone, cast(z.i as int) as z_zone from range(3) x(i), range(3) z(i)),
full_grid as (select cast((2 - g.z_zone) * 3 + g.x_zone + 1 as int) as zone, g.x_zone, g.z_zone,
 cast(coalesce(gz.n_pitches, 0) as bigint) as n_pitches, coalesce(gz.p, 0) as p
 from grid g left join gz on g.x_zone = gz.x_zone and g.z_zone = gz.z_zone)"""
SQL["zone_grid_count"] = with_base(
    "select zone, x_zone, z_zone, n_pitches, cast(n_pitches as double) as value from full_grid", extra=_GRID)
SQL["zone_grid_prob"] = with_base("select zone, x_zone, z_zone, n_pitches, p as value from full_grid", extra=_GRID)
SQL["zone_grid_scaled"] = with_base("""
select zone, x_zone, z_zone, n_pitches, cast(n_pitches as double) as value,
 cast(n_pitches as double) / case when max(n_pitches) over () > 0 then cast(max(n_pitches) over () as double) else 1.0 end as scaled
from full_grid""", extra=_GRID)
SQL["speed_histogram"] = with_base("""
select is_strike, bin, case when bin >= 30 then hi else bin * ((hi - lo) / 30) + lo end as bin_lo,
 case when bin + 1 >= 30 then hi else (bin + 1) * ((hi - lo) / 30) + lo end as bin_hi, count(*) as n
from (
 select c.is_strike, e.lo, e.hi,
  cast(least(len(list_filter(e.edges, lambda w: w <= c.release_speed)) - 1, 29) as int) as bin
 from clean c join (
  select is_strike, lo, hi, list_transform(range(0, 31), lambda i: case when i = 30 then hi else i * ((hi - lo) / 30) + lo end) as edges
  from (select is_strike, case when lo0 = hi0 then lo0 - 0.5 else lo0 end as lo, case when lo0 = hi0 then hi0 + 0.5 else hi0 end as hi
        from (select is_strike, min(release_speed) as lo0, max(release_speed) as hi0 from clean
              where release_speed is not null group by is_strike) b0) b1) e
 on c.is_strike = e.is_strike where c.release_speed is not null) t
group by is_strike, bin, lo, hi""")

# --- features -------------------------------------------------------------------
_KEYS = "l_orderkey, l_partkey, l_suppkey, l_linenumber, game_date"
_NUM = S.NUMERIC_FEATURES
# Categories observed in the cleaned fixture (sorted; the first is dropped).
_CATS = {
    "pitch_type": ["CH", "CU", "FC", "FF", "SI", "SL", "ST", "Unknown"],
    "stand": ["L", "R"],
    "p_throws": ["L", "R"],
    "inning_topbot": ["Bot", "Top", "Unknown"],
}
_ENG = """eng as (select *, (sz_top + sz_bot) / 2.0 as zone_mid,
 sqrt(plate_x * plate_x + (plate_z - (sz_top + sz_bot) / 2.0) * (plate_z - (sz_top + sz_bot) / 2.0)) as dist_to_zone_center
 from clean)"""
_MED = "med as (select " + ", ".join(f"median(cast({c} as double)) as m_{c}" for c in _NUM) + " from eng)"
_ONEHOT = ", ".join(
    f"case when coalesce({c}, 'Unknown') = '{v}' then cast(1.0 as double) else cast(0.0 as double) end as {c}_{v}"
    for c, vals in _CATS.items() for v in vals[1:])
_IMPUTED = ", ".join(f"round(coalesce(cast({c} as double), m_{c}), 6) as {c}" for c in _NUM)
_ONEHOT_R = ", ".join(
    f"round(case when coalesce({c}, 'Unknown') = '{v}' then cast(1.0 as double) else cast(0.0 as double) end, 6) as {c}_{v}"
    for c, vals in _CATS.items() for v in vals[1:])

SQL["zone_geometry"] = with_base(f"select {_KEYS}, zone_mid, dist_to_zone_center from eng", extra=_ENG)
SQL["impute_median"] = with_base(f"select {_KEYS}, {_IMPUTED} from eng, med", extra=_ENG + ",\n" + _MED)
SQL["fill_unknown"] = with_base(
    f"select {_KEYS}, " + ", ".join(f"coalesce({c}, 'Unknown') as {c}" for c in S.CATEGORICAL_FEATURES) + " from clean")
SQL["one_hot"] = with_base(f"select {_KEYS}, {_ONEHOT} from clean")
SQL["coerce_numeric"] = with_base(f"""select {_KEYS}, coalesce(try_cast(cast(balls as varchar) as double), 0.0) as balls_num,
 coalesce(try_cast(pitch_type as double), 0.0) as pitch_type_num,
 coalesce(try_cast(cast(on_1b as varchar) as double), 0.0) as on_1b_num from clean""")
SQL["feature_matrix"] = with_base(f"select {_KEYS}, is_strike, {_IMPUTED}, {_ONEHOT_R} from eng, med",
                                  extra=_ENG + ",\n" + _MED)
_SCEN = """scen as (select l_orderkey, l_partkey, l_suppkey, l_linenumber, game_date, balls, strikes, outs_when_up,
 on_1b, on_2b, on_3b, release_speed, pfx_x, pfx_z, case when l_orderkey % 7 = 0 then null else plate_x end as plate_x,
 plate_z, sz_bot, case when l_partkey % 13 = 0 then 'KN' else pitch_type end as pitch_type, stand, p_throws, inning_topbot
 from clean),
scen2 as (select s.*, m.m_sz_top as sz_top, (m.m_sz_top + s.sz_bot) / 2.0 as zone_mid from scen s, med m),
scen3 as (select *, sqrt(plate_x * plate_x + (plate_z - zone_mid) * (plate_z - zone_mid)) as dist_to_zone_center from scen2)"""
_SERVE_NUM = ", ".join(
    (f"round(coalesce(cast({c} as double), 0.0), 6) as {c}" if c in S.ENGINEERED_FEATURES
     else f"round(coalesce(cast({c} as double), m_{c}), 6) as {c}") for c in _NUM)
SQL["featurize_with_state"] = with_base(f"select {_KEYS}, {_SERVE_NUM}, {_ONEHOT_R} from scen3, med",
                                        extra=_ENG + ",\n" + _MED + ",\n" + _SCEN)

# --- split, scoring, evaluation ------------------------------------------------------
_SPLIT = f"""split_rows as (select *, case when row_number() over (partition by is_strike order by h)
  <= cast(floor(cast(0.2 as double) * n + 0.5) as bigint) then 'test' else 'train' end as split
 from (select *, md5(concat_ws('|', '42', cast(l_orderkey as varchar), cast(l_partkey as varchar), cast(l_suppkey as varchar),
   cast(l_linenumber as varchar), cast(game_date as varchar))) as h, count(*) over (partition by is_strike) as n from clean) t)"""
SQL["stratified_split"] = with_base(f"select {_KEYS}, is_strike, split from split_rows", extra=_SPLIT)
SQL["split_balance"] = with_base(
    "select split, count(*) as n_rows, avg(is_strike) as strike_rate from split_rows group by split", extra=_SPLIT)
_PRED = _SPLIT + """,
majority as (select is_strike as cls from split_rows where split = 'train' group by is_strike order by count(*) desc, is_strike limit 1),
test_eng as (select *, sqrt(plate_x * plate_x + (plate_z - (sz_top + sz_bot) / 2.0) * (plate_z - (sz_top + sz_bot) / 2.0)) as dist
 from split_rows where split = 'test'),
preds as (
 select l_orderkey, l_partkey, l_suppkey, l_linenumber, game_date, 'baseline' as model, is_strike as label,
  (select cls from majority) as prediction, cast((select cls from majority) as double) as score from test_eng
 union all
 select l_orderkey, l_partkey, l_suppkey, l_linenumber, game_date, 'zone_rule' as model, is_strike as label,
  case when 1.0 / (1.0 + floor(4.0 * coalesce(dist, 100.0))) >= 0.5 then 1 else 0 end as prediction,
  1.0 / (1.0 + floor(4.0 * coalesce(dist, 100.0))) as score from test_eng),
conf as (select model, count(*) filter (where label = 1 and prediction = 1) as tp,
 count(*) filter (where label = 0 and prediction = 1) as fp, count(*) filter (where label = 1 and prediction = 0) as fn,
 count(*) filter (where label = 0 and prediction = 0) as tn from preds group by model),
mets as (select model,
 case when tp + fp + fn + tn = 0 then 0.0 else cast(tp + tn as double) / cast(tp + fp + fn + tn as double) end as accuracy,
 case when tp + fp = 0 then 0.0 else cast(tp as double) / cast(tp + fp as double) end as precision,
 case when tp + fn = 0 then 0.0 else cast(tp as double) / cast(tp + fn as double) end as recall,
 case when 2 * tp + fp + fn = 0 then 0.0 else cast(2 * tp as double) / cast(2 * tp + fp + fn as double) end as f1 from conf),
st as (select model, score, count(*) filter (where label = 1) as pos, count(*) filter (where label = 0) as neg
 from preds where score is not null group by model, score),
cum as (select *, sum(neg) over (partition by model order by score rows between unbounded preceding and current row) as cum_neg,
 sum(pos) over (partition by model order by score rows between unbounded preceding and current row) as cum_pos,
 sum(pos) over (partition by model) as tot_p, sum(neg) over (partition by model) as tot_n from st),
auc as (select model, case when sum(pos) * sum(neg) > 0 then
  sum(cast(pos as double) * (cum_neg - neg + neg / 2.0)) / (cast(sum(pos) as double) * cast(sum(neg) as double)) end as roc_auc,
 cast(sum(pos) as bigint) as n_pos, cast(sum(neg) as bigint) as n_neg from cum group by model)"""
SQL["baseline_predict"] = with_base("select * from preds where model = 'baseline'", extra=_PRED)
SQL["score_bands"] = with_base(f"""
select {_KEYS}, score, case when score >= 0.5 then 'Strike' else 'Ball' end as call,
 case when score >= 0.7 then 'high' when score >= 0.5 then 'moderate' else 'low' end as band
from (select *, 1.0 / (1.0 + floor(4.0 * coalesce(dist_to_zone_center, 100.0))) as score from eng) t""", extra=_ENG)
SQL["classification_metrics"] = with_base("select * from mets", extra=_PRED)
SQL["roc_auc"] = with_base("select model, round(roc_auc, 6) as roc_auc, n_pos, n_neg from auc", extra=_PRED)
SQL["roc_curve"] = with_base("""
select model, score as threshold,
 case when tot_n = 0 then 0.0 else cast(tot_n - (cum_neg - neg) as double) / cast(tot_n as double) end as fpr,
 case when tot_p = 0 then 0.0 else cast(tot_p - (cum_pos - pos) as double) / cast(tot_p as double) end as tpr from cum
union all
select distinct model, cast(null as double) as threshold, 0.0 as fpr, 0.0 as tpr from st""", extra=_PRED)
SQL["metrics_by_model"] = with_base("""
select m.model, round(accuracy, 6) as accuracy, round(precision, 6) as precision, round(recall, 6) as recall,
 round(f1, 6) as f1, round(a.roc_auc, 6) as roc_auc from mets m left join auc a on m.model = a.model""", extra=_PRED)

# --- roster -----------------------------------------------------------------------
_ROSTER = """roster as (select * from (values (0, 'red', 'plate', 'R'), (1, 'small', 'widget', 'R'), (2, 'hot', 'plate', 'L'),
 (3, 'large', 'rod', 'L'), (4, 'blue', 'bolt', 'R'), (5, 'purple', 'unicorn', 'R')) t(roster_pos, first, last, throws)),
firsts as (select split_part(p_name, ' ', 1) as first, split_part(p_name, ' ', 2) as last, min(p_partkey) as player_id
 from part where p_partkey is not null group by 1, 2),
ids as (select r.*, f.player_id from roster r join firsts f on r.first = f.first and r.last = f.last),
tagged as (select c.*, i.first as pitcher_first, i.last as pitcher_last, i.first || ' ' || i.last as pitcher_name,
 i.throws as throws_config from clean c join ids i on c.l_partkey = i.player_id)"""
SQL["roster_join"] = with_base(
    f"select {_KEYS}, is_strike, pitcher_first, pitcher_last, pitcher_name, throws_config from tagged", extra=_ROSTER)
SQL["roster_coverage"] = with_base("""
select r.roster_pos, r.first, r.last, cast(coalesce(t.n, 0) as bigint) as n_pitches, coalesce(t.n, 0) > 0 as succeeded
from roster r left join (select pitcher_first, pitcher_last, count(*) as n from tagged group by 1, 2) t
 on r.first = t.pitcher_first and r.last = t.pitcher_last""", extra=_ROSTER)
SQL["union_sources"] = with_base(f"""
select {_KEYS}, pitcher_name, throws_config, cast(null as double) as release_speed from tagged where throws_config = 'R'
union all
select {_KEYS}, pitcher_name, cast(null as varchar) as throws_config, release_speed from tagged where throws_config <> 'R'""",
                                 extra=_ROSTER)
SQL["tag_roster"] = with_base(
    f"select {_KEYS}, 'Gerrit' as pitcher_first, 'Cole' as pitcher_last, 'Gerrit Cole' as pitcher_name, 'R' as throws_config from clean")

SQL["axis_extents"] = with_base(
    "select min(plate_x) as x_min, max(plate_x) as x_max, min(plate_z) as z_min, max(plate_z) as z_max from clean")
SQL["shown_vs_total"] = with_base(
    "select count(*) filter (where pitch_type in ('FF', 'CH', 'ST')) as n_shown, count(*) as n_total from clean")
SQL["missing_pitchers"] = with_base("""
select r.roster_pos, r.first, r.last, r.throws from roster r
where not exists (select 1 from tagged t where t.pitcher_first = r.first and t.pitcher_last = r.last)""", extra=_ROSTER)
SQL["value_counts_by_target"] = with_base("select is_strike, count(*) as n from clean group by is_strike")
SQL["value_counts_by_hand"] = with_base(
    "select p_throws, count(*) as n from clean where p_throws is not null group by p_throws")

# --- other tables ---------------------------------------------------------------------
SQL["events_value_counts"] = "select event_type, count(*) as n from events where event_type is not null group by event_type"
SQL["events_histogram"] = """
select event_type, bin, case when bin >= 30 then hi else bin * ((hi - lo) / 30) + lo end as bin_lo,
 case when bin + 1 >= 30 then hi else (bin + 1) * ((hi - lo) / 30) + lo end as bin_hi, count(*) as n
from (
 select c.event_type, e.lo, e.hi,
  cast(least(len(list_filter(e.edges, lambda w: w <= c.value)) - 1, 29) as int) as bin
 from events c join (
  select event_type, lo, hi, list_transform(range(0, 31), lambda i: case when i = 30 then hi else i * ((hi - lo) / 30) + lo end) as edges
  from (select event_type, case when lo0 = hi0 then lo0 - 0.5 else lo0 end as lo, case when lo0 = hi0 then hi0 + 0.5 else hi0 end as hi
        from (select event_type, min(value) as lo0, max(value) as hi0 from events
              where value is not null and not isnan(value) group by event_type) b0) b1) e
 on c.event_type = e.event_type where c.value is not null and not isnan(c.value)) t
group by event_type, bin, lo, hi"""
SQL["events_describe"] = """
select event_type, count(*) as count, round(avg(value), 6) as mean, round(stddev_samp(value), 6) as std,
 round(min(value), 6) as min, round(quantile_cont(value, 0.25), 6) as q25, round(quantile_cont(value, 0.5), 6) as q50,
 round(quantile_cont(value, 0.75), 6) as q75, round(max(value), 6) as max
from events where value is not null and not isnan(value) group by event_type"""
SQL["orders_rate_by_priority"] = """
select o_orderpriority, count(*) as n_pitches, avg(cast(o_orderstatus = 'F' as int)) as strike_rate
from orders where o_orderpriority is not null group by o_orderpriority"""

# --- many groups, continuous scores, text numbers ------------------------------------
SQL["events_describe_by_user"] = """
select user_id, count(*) as count, round(avg(value), 6) as mean, round(stddev_samp(value), 6) as std,
 round(min(value), 6) as min, round(quantile_cont(value, 0.25), 6) as q25, round(quantile_cont(value, 0.5), 6) as q50,
 round(quantile_cont(value, 0.75), 6) as q75, round(max(value), 6) as max
from events where value is not null group by user_id"""
SQL["orders_median_by_customer"] = """
select o_custkey, count(o_totalprice) as n, round(quantile_cont(o_totalprice, 0.5), 6) as median from orders
where o_totalprice is not null group by o_custkey"""
_CONT = """cont as (select is_strike as label, cast(1 as double) / (1 + coalesce(sqrt(plate_x * plate_x
  + (plate_z - (sz_top + sz_bot) / 2) * (plate_z - (sz_top + sz_bot) / 2)), 100)) as score from clean),
dist as (select score, count(*) filter (where label = 1) as pos, count(*) filter (where label = 0) as neg from cont group by score),
run as (select score, pos, neg, sum(pos) over (order by score) as cpos, sum(neg) over (order by score) as cneg from dist),
tot as (select sum(pos) as p, sum(neg) as n from dist)"""
SQL["roc_auc_continuous"] = with_base("""
select 'distance' as model, round(sum(cast(pos as double) * (cneg - neg + neg / 2.0)) / (any_value(tot.p) * cast(any_value(tot.n) as double)), 6) as roc_auc,
 cast(any_value(tot.p) as bigint) as n_pos, cast(any_value(tot.n) as bigint) as n_neg from run, tot""", extra=_CONT)
SQL["roc_curve_continuous"] = with_base("""
select 'distance' as model, round(score, 9) as threshold, round(cast(n - (cneg - neg) as double) / n, 9) as fpr,
 round(cast(p - (cpos - pos) as double) / p, 9) as tpr from run, tot
union all select 'distance', null, 0.0, 0.0""", extra=_CONT)
SQL["coerce_numeric_text"] = """
select event_id, case when regexp_full_match(props, '\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*')
  then cast(props as double) else 0.0 end as props_num, cast(0 as double) as suffixed, cast(user_id as double) as user_num from events"""
SQL["roster_null_first"] = """
with r(first, last) as (values ('red', 'plate'), ('small', 'widget'), ('hot', 'plate'), ('large', 'rod'), ('blue', 'bolt'), ('purple', 'unicorn')),
m as (select split_part(p_name, ' ', 1) as first, split_part(p_name, ' ', 2) as last, min(p_partkey) as k from part group by 1, 2)
select first, last, k as player_id from r join m using (first, last) where k % 3 <> 0"""
SQL["logistic_score_counts"] = with_base("""
select 'logistic_regression' as model, is_strike as label, count(*) as n, count(*) as n_probabilities
from split_rows where split = 'test' group by is_strike""", extra=_SPLIT)
