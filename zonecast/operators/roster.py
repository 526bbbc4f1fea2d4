"""Roster lookups: names -> player ids, tagging pitches, coverage, unions.

The roster (checked to be small) is broadcast to the people scan, so only rows
with a roster name are aggregated; the resolved ids have at most a row per
roster name and hand and are broadcast to the pitch scan under the same check.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast import schema as S
from zonecast.operators.prep import first_non_empty

MAX_ROSTER = 100_000  # rows that are broadcast; a larger roster is joined by a shuffle


def roster_frame(spark: SparkSession, pitchers: Sequence[dict] = S.PITCHERS) -> DataFrame:
    """Roster as a DataFrame; the hand comes from 'throws' or, failing that, 'handedness'."""
    rows = [(i, p["first"], p["last"], p.get("throws"), p.get("handedness")) for i, p in enumerate(pitchers)]
    df = spark.createDataFrame(rows, "roster_pos int, first string, last string, throws string, handedness string")
    return df.select("roster_pos", "first", "last", first_non_empty("throws", "handedness").alias("throws"))


def resolve_ids(roster: DataFrame, people: DataFrame, first_col: str = "name_first", last_col: str = "name_last",
                id_col: str = "player_id", order_col: str | None = None) -> DataFrame:
    """Id of the first matching person per roster name (smallest ``order_col``; default the id, nulls
    first).  Names with no match are absent, and so are names whose first match has a null id."""
    order_col = order_col or id_col
    names = roster.select("first", "last").distinct()
    named = people.select(F.col(first_col).alias("first"), F.col(last_col).alias("last"),
                          F.struct(F.col(order_col).alias("o"), F.col(id_col).alias("id")).alias("m"))
    wanted = named.join(_small(names), on=["first", "last"], how="left_semi")
    first_match = wanted.groupBy("first", "last").agg(F.min("m").alias("m")).select(
        "first", "last", F.col("m.id").alias("player_id")).filter(F.col("player_id").isNotNull())
    return roster.join(first_match, on=["first", "last"], how="inner")


def _small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if it is counted within the bound."""
    return F.broadcast(df) if df.limit(MAX_ROSTER + 1).count() <= MAX_ROSTER else df


def tag_pitches(pitches: DataFrame, ids: DataFrame, pitcher_col: str) -> DataFrame:
    """Inner join pitches to resolved roster ids, adding pitcher_first/last/name/throws_config."""
    tags = ids.select(F.col("player_id").alias(pitcher_col), F.col("first").alias("pitcher_first"),
                      F.col("last").alias("pitcher_last"),
                      F.concat_ws(" ", "first", "last").alias("pitcher_name"),
                      F.col("throws").alias("throws_config"))
    return pitches.join(_small(tags), on=pitcher_col, how="inner")


def roster_coverage(roster: DataFrame, tagged: DataFrame) -> DataFrame:
    """Per roster entry: pitches found and whether the entry succeeded (>0 rows)."""
    counts = tagged.groupBy(F.col("pitcher_first").alias("first"), F.col("pitcher_last").alias("last")).agg(
        F.count(F.lit(1)).alias("n_pitches"))
    out = roster.join(counts, on=["first", "last"], how="left").select(
        "roster_pos", "first", "last", F.coalesce("n_pitches", F.lit(0)).cast("long").alias("n_pitches"))
    return out.withColumn("succeeded", F.col("n_pitches") > 0)


def missing_pitchers(roster: DataFrame, tagged: DataFrame) -> DataFrame:
    """Roster entries with no pitch data (left anti join)."""
    found = tagged.select(F.col("pitcher_first").alias("first"), F.col("pitcher_last").alias("last")).distinct()
    return roster.join(found, on=["first", "last"], how="left_anti")


def require_any(tagged: DataFrame) -> DataFrame:
    if tagged.isEmpty():
        raise ValueError("none of the roster has a pitch")
    return tagged


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Row union by column name; columns missing from a frame are null."""
    if not frames:
        raise ValueError("nothing to union")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
