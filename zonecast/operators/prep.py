"""Labelling, cleaning and filtering operators (narrow: no shuffle).

Each returns a lazy DataFrame; Catalyst combines the successive filters into one
and pushes the simple ones into the parquet scan.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast import schema as S
from zonecast.functions import col_or_lit, strike_label

_NUMERIC = (T.DoubleType, T.FloatType)


def _is_floating(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, _NUMERIC)


# --- P1 / P2 ----------------------------------------------------------------

def label_outcomes(df: DataFrame, description_col: str = "description", label_col: str = "is_strike",
                   strikes: Sequence[str] = S.STRIKE_DESCRIPTIONS,
                   balls: Sequence[str] = S.BALL_DESCRIPTIONS) -> DataFrame:
    """Add an int 0/1 label from the description and drop rows matching neither list."""
    S.require_columns(df, [description_col])
    d = F.col(description_col)
    # Filter on the description itself (referenced once) and give the label a
    # non-nullable form, so later null checks on it fold away.
    kept = df.filter(d.isin(list(strikes) + list(balls)))
    return kept.withColumn(label_col, F.when(d.isin(list(strikes)), F.lit(1)).otherwise(F.lit(0)))


def label_audit(df: DataFrame, description_col: str = "description",
                strikes: Sequence[str] = S.STRIKE_DESCRIPTIONS,
                balls: Sequence[str] = S.BALL_DESCRIPTIONS) -> DataFrame:
    """One row: input, kept, strikes, balls and dropped counts (one partial aggregate)."""
    lab = strike_label(description_col, strikes, balls)
    return df.agg(
        F.count(F.lit(1)).alias("n_input"),
        F.count_if(lab.isNotNull()).alias("n_kept"),
        F.count_if(lab == 1).alias("n_strikes"),
        F.count_if(lab == 0).alias("n_balls"),
        F.count_if(lab.isNull()).alias("n_dropped"),
    )


# --- P3 / P4 / P5 -----------------------------------------------------------

def speed_condition(speed_col: str = "release_speed", lo: float = S.MIN_RELEASE_SPEED,
                    hi: float = S.MAX_RELEASE_SPEED) -> Column:
    # Both bounds are needed: NaN >= lo is true in Spark but NaN <= hi is false.
    c = F.col(speed_col)
    return (c >= F.lit(lo)) & (c <= F.lit(hi))


def speed_bounds(df: DataFrame, speed_col: str = "release_speed", lo: float = S.MIN_RELEASE_SPEED,
                 hi: float = S.MAX_RELEASE_SPEED) -> DataFrame:
    """Keep lo <= speed <= hi (null/NaN removed); no-op when the column is absent."""
    if speed_col not in df.columns:
        return df
    return df.filter(speed_condition(speed_col, lo, hi))


def drop_missing_critical(df: DataFrame, columns: Sequence[str] = S.CRITICAL_COLUMNS) -> DataFrame:
    """Drop rows null (or NaN) in any of the listed columns that are present."""
    cond = None
    for c in columns:
        if c not in df.columns:
            continue
        f = df.schema[c]
        ok = F.col(c).isNotNull()
        if _is_floating(df, c):
            ok = ok & ~F.isnan(c)
        elif not f.nullable:
            continue  # cannot be missing
        cond = ok if cond is None else cond & ok
    return df if cond is None else df.filter(cond)


def basic_cleaning(df: DataFrame, speed_col: str = "release_speed",
                   critical: Sequence[str] = S.CRITICAL_COLUMNS) -> DataFrame:
    return drop_missing_critical(speed_bounds(df, speed_col), critical)


def cleaning_audit(df: DataFrame, speed_col: str = "release_speed",
                   critical: Sequence[str] = S.CRITICAL_COLUMNS) -> DataFrame:
    """Rows removed per successive cleaning step, in one pass.

    Each row is attributed to the first step that removes it (speed, then each
    critical column in order) or to ``kept``.  Output: (step_order, step, n_rows).
    """
    steps: list[tuple[str, Column]] = []
    if speed_col in df.columns:
        steps.append((speed_col, ~F.coalesce(speed_condition(speed_col), F.lit(False))))
    for c in critical:
        if c in df.columns:
            miss = F.col(c).isNull()
            if _is_floating(df, c):
                miss = miss | F.isnan(c)
            steps.append((c, miss))
    step_name = F.lit("kept")
    step_ord = F.lit(len(steps) + 1)
    for i, (name, cond) in reversed(list(enumerate(steps, start=1))):
        step_name = F.when(cond, F.lit(name)).otherwise(step_name)
        step_ord = F.when(cond, F.lit(i)).otherwise(step_ord)
    return (df.select(step_ord.cast("int").alias("step_order"), step_name.alias("step"))
            .groupBy("step_order", "step").agg(F.count(F.lit(1)).alias("n_rows")))


# --- P6 / P7 / P8 / P9 / A15 -----------------------------------------------

def multiselect_condition(df: DataFrame, pitch_types: Sequence[str] | None,
                          pitchers: Sequence[str] | None = None,
                          pitch_type_col: str = "pitch_type", pitcher_col: str = "pitcher_name") -> Column:
    """Dashboard multi-select rule: an empty pitch-type list matches nothing,
    an empty (or absent) pitcher list applies no filter."""
    cond = F.col(pitch_type_col).isin(list(pitch_types or [])) if pitch_types else F.lit(False)
    if pitchers and pitcher_col in df.columns:
        cond = cond & F.col(pitcher_col).isin(list(pitchers))
    return F.coalesce(cond, F.lit(False))


def filter_multiselect(df: DataFrame, pitch_types: Sequence[str] | None,
                       pitchers: Sequence[str] | None = None, **kw) -> DataFrame:
    return df.filter(multiselect_condition(df, pitch_types, pitchers, **kw))


def shown_vs_total(df: DataFrame, condition: Column) -> DataFrame:
    """(n_shown, n_total) for an active filter, one conditional aggregate."""
    return df.agg(F.count_if(condition).alias("n_shown"), F.count(F.lit(1)).alias("n_total"))


ALL = "All"


def filter_slice(df: DataFrame, **equalities) -> DataFrame:
    """AND of optional equality filters; a value of 'All' (or None) skips that column,
    as does a column the frame does not have."""
    for c, v in equalities.items():
        if v is None or (isinstance(v, str) and v == ALL) or c not in df.columns:
            continue
        df = df.filter(F.col(c) == F.lit(v))
    return df


def min_rows_gate(df: DataFrame, min_rows: int) -> DataFrame:
    """All rows when the frame has at least ``min_rows`` rows, else none.

    The count is a scalar subquery (one partial aggregate), not a cross join.
    """
    n = df.select(F.count(F.lit(1))).scalar()
    return df.filter(n >= F.lit(min_rows))


def date_range(df: DataFrame, start: str = S.DEFAULT_START_DATE, end: str = S.DEFAULT_END_DATE,
               date_col: str = "game_date") -> DataFrame:
    """Inclusive date restriction; on a table partitioned by date this prunes partitions."""
    return df.filter(F.col(date_col).between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))


# --- P10 / P11 / P12 / P13 / P14 -------------------------------------------

def tag_constant(df: DataFrame, first: str, last: str, throws: str | None = None) -> DataFrame:
    out = (df.withColumn("pitcher_first", F.lit(first))
           .withColumn("pitcher_last", F.lit(last))
           .withColumn("pitcher_name", F.lit(f"{first} {last}")))
    if throws is not None:
        out = out.withColumn("throws_config", F.lit(throws))
    return out


def derive_name(df: DataFrame, first_col: str = "pitcher_first", last_col: str = "pitcher_last",
                name_col: str = "pitcher_name") -> DataFrame:
    """Add ``first + ' ' + last`` when the name column is absent (null if either part is null)."""
    if name_col in df.columns or first_col not in df.columns or last_col not in df.columns:
        return df
    return df.withColumn(name_col, F.concat(F.col(first_col), F.lit(" "), F.col(last_col)))


def first_non_empty(a: str | Column, b: str | Column) -> Column:
    """First of two keys that is neither null nor empty (``a or b``)."""
    return F.coalesce(F.nullif(col_or_lit(a), F.lit("")), col_or_lit(b))


def available_features(df: DataFrame, columns: Sequence[str]) -> list[str]:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        warnings.warn(f"features without a column are left out: {missing}", stacklevel=2)
    return [c for c in columns if c in df.columns]


def dataset_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)
