"""Pitch rows derived from the driver's ``lineitem`` table.

The driver tables hold no pitches, so tests and registered queries derive a
pitch table from ``lineitem`` with integer modulo arithmetic and plain double
division only (both Spark and DuckDB give the same rows).  The derivation is a
single narrow projection: no shuffle, every lineitem column it does not need is
pruned at the parquet scan.

``PITCH_VIEW_SQL`` is the same derivation as DuckDB SQL, used by the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast import schema as S
from zonecast.sources.scan import spread

# Columns kept from lineitem that identify a row: (orderkey, partkey, suppkey,
# linenumber, shipdate) is unique at every scale factor.
KEY_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "game_date"]


def _d(x) -> Column:
    return F.lit(float(x))


def _nullif(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def pitch_view_from_lineitem(lineitem: DataFrame) -> DataFrame:
    ok, pk, sk, ln = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    base = lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_linestatus", "l_returnflag",
        "l_quantity", "l_discount", "l_tax", "l_shipdate",
        ((pk * 7 + ln * 5 + ok) % 15).alias("k"),
        ((ok + ln) % 6).alias("k2"),
        _nullif(ok % 89 == 0,
                ((((pk * 7919 + ok * 31) % 4001).cast("double") - _d(2000)) / _d(1600))).alias("plate_x"),
        _nullif(ok % 83 == 0,
                (((pk * 104729 + ln * 613 + ok * 17) % 5001).cast("double") / _d(1000))).alias("plate_z"),
    )
    in_zone = F.coalesce(
        (F.abs("plate_x") <= _d(0.83)) & (F.col("plate_z") >= _d(1.5)) & (F.col("plate_z") <= _d(3.5)),
        F.lit(False),
    )
    k, k2 = F.col("k"), F.col("k2")

    strike_names = F.array(*[F.lit(x) for x in S.STRIKE_DESCRIPTIONS])
    ball_names = F.array(*[F.lit(x) for x in S.BALL_DESCRIPTIONS])
    # (in_zone and k <> 0) or (not in_zone and k <= 1), with in_zone evaluated once
    strike_like = F.when(in_zone, k != 0).otherwise(k <= 1)
    idx = k2.cast("int") + 1  # element_at is 1-based
    description = (
        F.when(k == 12, "hit_into_play")
        .when(k == 13, "foul_bunt")
        .when(k == 14, F.lit(None))
        .when(strike_like, F.element_at(strike_names, idx))
        .otherwise(F.element_at(ball_names, idx))
    )
    pitch_types = ["FF", "SL", "CH", "CU", "SI", "FC", "ST"]
    pt = F.when(pk % 8 == 0, pitch_types[0])
    for i, name in enumerate(pitch_types[1:], start=1):
        pt = pt.when(pk % 8 == i, name)

    # Filters on these columns must not be rewritten into filters on their formulas: cleaning would then
    # hold every formula several times, in a method too long for the JVM's compiler.  A generator stops that.
    made = base.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_linestatus", "l_returnflag", "l_discount", "l_tax", "l_shipdate",
        F.inline(F.array(F.struct(
            description.alias("description"),
            _nullif(pk % 97 == 0, F.col("l_quantity") + _d(57)).alias("release_speed"),
            "plate_x", "plate_z",
            _nullif(ok % 101 == 0, (ln % 4).cast("int")).alias("balls"),
            _nullif(ok % 103 == 0, (ok % 3).cast("int")).alias("strikes")))),
    )
    return made.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.col("l_shipdate").cast("date").alias("game_date"),
        "description", "release_speed", "plate_x", "plate_z", "balls", "strikes",
        pt.alias("pitch_type"),
        F.when(F.col("l_linestatus") == "F", "R").otherwise("L").alias("stand"),
        F.when(sk % 3 == 0, "L").otherwise("R").alias("p_throws"),
        F.when(F.col("l_returnflag") == "A", "Top").when(F.col("l_returnflag") == "R", "Bot").alias("inning_topbot"),
        (sk % 3).cast("int").alias("outs_when_up"),
        F.when(ok % 3 == 0, (pk + 600000).cast("double")).alias("on_1b"),
        F.when(ok % 5 == 0, (sk + 600000).cast("double")).alias("on_2b"),
        F.when(ok % 11 == 0, (ln + 600000).cast("double")).alias("on_3b"),
        _nullif(ln == 7, (pk % 50 + 320).cast("double") / _d(100)).alias("sz_top"),
        _nullif(ln == 6, (sk % 40 + 140).cast("double") / _d(100)).alias("sz_bot"),
        ((F.col("l_discount") - _d(0.05)) * _d(20)).alias("pfx_x"),
        ((F.col("l_tax") - _d(0.04)) * _d(20)).alias("pfx_z"),
    )


LINEITEM_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_linestatus", "l_returnflag",
                    "l_quantity", "l_discount", "l_tax", "l_shipdate"]


def pitch_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw pitch table for a scale-factor directory (pruned scan, spread over the cluster)."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*LINEITEM_COLUMNS)
    return pitch_view_from_lineitem(spread(li))


# DuckDB text of the same derivation (oracle side).
PITCH_VIEW_SQL = """
select l_orderkey, l_partkey, l_suppkey, l_linenumber,
 cast(l_shipdate as date) as game_date,
 case when k = 12 then 'hit_into_play' when k = 13 then 'foul_bunt' when k = 14 then null
  when (in_zone and k <> 0) or (not in_zone and k <= 1) then
   case k2 when 0 then 'called_strike' when 1 then 'swinging_strike' when 2 then 'swinging_strike_blocked' when 3 then 'foul' when 4 then 'foul_tip' else 'missed_bunt' end
  else
   case k2 when 0 then 'ball' when 1 then 'blocked_ball' when 2 then 'intent_ball' when 3 then 'ball_in_dirt' when 4 then 'pitchout' else 'hit_by_pitch' end
 end as description,
 case when l_partkey % 97 = 0 then null else l_quantity + cast(57 as double) end as release_speed,
 plate_x, plate_z,
 case when l_orderkey % 101 = 0 then null else cast(l_linenumber % 4 as int) end as balls,
 case when l_orderkey % 103 = 0 then null else cast(l_orderkey % 3 as int) end as strikes,
 case l_partkey % 8 when 0 then 'FF' when 1 then 'SL' when 2 then 'CH' when 3 then 'CU' when 4 then 'SI' when 5 then 'FC' when 6 then 'ST' else null end as pitch_type,
 case when l_linestatus = 'F' then 'R' else 'L' end as stand,
 case when l_suppkey % 3 = 0 then 'L' else 'R' end as p_throws,
 case when l_returnflag = 'A' then 'Top' when l_returnflag = 'R' then 'Bot' else null end as inning_topbot,
 cast(l_suppkey % 3 as int) as outs_when_up,
 case when l_orderkey % 3 = 0 then cast(600000 + l_partkey as double) else null end as on_1b,
 case when l_orderkey % 5 = 0 then cast(600000 + l_suppkey as double) else null end as on_2b,
 case when l_orderkey % 11 = 0 then cast(600000 + l_linenumber as double) else null end as on_3b,
 case when l_linenumber = 7 then null else cast(320 + l_partkey % 50 as double) / cast(100 as double) end as sz_top,
 case when l_linenumber = 6 then null else cast(140 + l_suppkey % 40 as double) / cast(100 as double) end as sz_bot,
 (l_discount - cast(0.05 as double)) * cast(20 as double) as pfx_x,
 (l_tax - cast(0.04 as double)) * cast(20 as double) as pfx_z
from (
 select *, coalesce(abs(plate_x) <= cast(0.83 as double) and plate_z >= cast(1.5 as double) and plate_z <= cast(3.5 as double), false) as in_zone
 from (
  select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_linestatus, l_returnflag,
   l_quantity, l_discount, l_tax, l_shipdate,
   (l_partkey*7 + l_linenumber*5 + l_orderkey) % 15 as k,
   (l_orderkey + l_linenumber) % 6 as k2,
   case when l_orderkey % 89 = 0 then null else (cast((l_partkey*7919 + l_orderkey*31) % 4001 as double) - cast(2000 as double)) / cast(1600 as double) end as plate_x,
   case when l_orderkey % 83 = 0 then null else cast((l_partkey*104729 + l_linenumber*613 + l_orderkey*17) % 5001 as double) / cast(1000 as double) end as plate_z
  from lineitem) base) z
"""
