"""One table of additive cells behind every panel of a filter state.

A cell is one combination of the dimensions with what can be added up: rows, strikes, and per measure its
count, sum, minimum and maximum.  It is built by one partial aggregate over the pitches and written;
every slice, rate, option list and total is then a small aggregate of cells, and a cube of all slices expands cells
instead of pitches.  Heatmaps and histograms are not here: their edges are those of the rows shown.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast import schema as S
from zonecast.functions import uniform_bin, zone_number
from zonecast.operators import prep
from zonecast.session import settled

LABEL = "is_strike"
SLICE_DIMS = ["pitch_type", "pitcher_name", "stand", "p_throws", "balls", "strikes"]
ZONE_DIMS = ["x_zone", "z_zone"]


def with_zone(df: DataFrame, x_col: str = "plate_x", z_col: str = "plate_z", n: int = 3) -> DataFrame:
    """The third of the zone a pitch is in, as two columns (null outside)."""
    x, z = F.col(x_col), F.col(z_col)
    left, right, low, high = (F.lit(v) for v in (S.ZONE_LEFT, S.ZONE_RIGHT, S.ZONE_BOTTOM, S.ZONE_TOP))
    inside = x.between(left, right) & z.between(low, high)
    return df.select("*", F.when(inside, uniform_bin(x, left, right, n, "right")).alias("x_zone"), F.when(inside, uniform_bin(z, low, high, n, "right")).alias("z_zone"))


def slice_cells(df: DataFrame, dims: Sequence[str], measures: Sequence[str] = ("release_speed",), label_col: str = LABEL) -> DataFrame:
    """dims, n_rows, n_labels, n_strikes, and ``<m>_n, <m>_sum, <m>_min, <m>_max`` per measure: one row per combination (null is a value)."""
    out = [F.count(F.lit(1)).alias("n_rows"), F.count(label_col).alias("n_labels"), F.sum(label_col).cast("long").alias("n_strikes")]
    for m in measures:
        v = F.col(m).cast("double")
        v = F.when(~F.isnan(v), v)
        out += [F.count(v).alias(f"{m}_n"), F.sum(v).alias(f"{m}_sum"), F.min(v).alias(f"{m}_min"), F.max(v).alias(f"{m}_max")]
    return df.groupBy(*dims).agg(*out)


def merged(cells: DataFrame, dims: Sequence[str] = ()) -> DataFrame:
    """Cells of fewer dimensions, or of several cell tables in a union (days, files) as one."""
    return cells.groupBy(*dims).agg(*_sums(cells))


def _sums(cells: DataFrame) -> list[Column]:
    how = {"_min": F.min, "_max": F.max}
    numbers = [c for c in cells.columns if c in ("n_rows", "n_labels", "n_strikes") or c[c.rfind("_") :] in ("_n", "_sum", "_min", "_max")]
    return [how.get(c[c.rfind("_") :], F.sum)(c).alias(c) for c in numbers]


def _rate() -> Column:
    return F.when(F.col("n_labels") > 0, F.col("n_strikes").cast("double") / F.col("n_labels"))


def slice_cube(cells: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Every slice of the dimensions: dims (null where the slice is over all values), ``slice_id``, n_pitches, n_strikes, strike_rate.

    ``slice_id`` has a bit per dimension, the first the highest: 1 if the slice is over all its values (so a null value and "all" differ).
    """
    every = cells.cube(*dims).agg(F.grouping_id().cast("long").alias("slice_id"), F.sum("n_rows").alias("n_pitches"), F.sum("n_labels").alias("n_labels"), F.sum("n_strikes").alias("n_strikes"))
    return every.select(*dims, "slice_id", "n_pitches", "n_strikes", _rate().alias("strike_rate"))


def chosen_slices(cells: DataFrame, sets: Sequence[Sequence[str]]) -> DataFrame:
    """Only the named slices (grouping sets), in the columns of ``slice_cube``."""
    dims = list(dict.fromkeys(d for s in sets for d in s))
    some = cells.groupingSets([[F.col(d) for d in s] for s in sets], *dims).agg(F.grouping_id().cast("long").alias("slice_id"), F.sum("n_rows").alias("n_pitches"), F.sum("n_labels").alias("n_labels"), F.sum("n_strikes").alias("n_strikes"))
    return some.select(*dims, "slice_id", "n_pitches", "n_strikes", _rate().alias("strike_rate"))


# --- the panels, from cells -----------------------------------------------------------------

def totals(cells: DataFrame) -> DataFrame:
    """As ``overview_totals``."""
    return cells.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_pitches"), F.sum("n_strikes").alias("n_strikes"), F.sum("n_labels").alias("n_labels")) \
        .select("n_pitches", "n_strikes", (F.col("n_pitches") - F.col("n_strikes")).alias("n_balls"), _rate().alias("strike_rate"))


def rate_by(cells: DataFrame, col: str) -> DataFrame:
    """As ``summaries.rate_by``."""
    g = cells.where(F.col(col).isNotNull()).groupBy(col).agg(F.sum("n_rows").alias("n_pitches"), F.sum("n_labels").alias("n_labels"), F.sum("n_strikes").alias("n_strikes"))
    return g.select(col, "n_pitches", _rate().alias("strike_rate")).orderBy(F.desc("strike_rate"), F.asc(col))


def rate_by_count_label(cells: DataFrame, min_rows: int = 10) -> DataFrame:
    """As ``summaries.rate_by_count_label``."""
    known = cells.where(F.col("balls").isNotNull() & F.col("strikes").isNotNull())
    g = known.groupBy("balls", "strikes").agg(F.sum("n_rows").alias("n_pitches"), F.sum("n_labels").alias("n_labels"), F.sum("n_strikes").alias("n_strikes")).where(F.col("n_pitches") >= min_rows)
    label = F.concat_ws("-", F.col("balls").cast("string"), F.col("strikes").cast("string"))
    return g.select(label.alias("count_label"), "n_pitches", _rate().alias("strike_rate"), F.col("balls").cast("int").alias("balls_sort"), F.col("strikes").cast("int").alias("strikes_sort")).orderBy("balls_sort", "strikes_sort")


def slice_summary(cells: DataFrame, speed_col: str = "release_speed") -> DataFrame:
    """As ``summaries.slice_summary``."""
    g = cells.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_pitches"), F.sum("n_labels").alias("n_labels"), F.sum("n_strikes").alias("n_strikes"), F.sum(f"{speed_col}_sum").alias("s"), F.sum(f"{speed_col}_n").alias("c"))
    return g.select("n_pitches", _rate().alias("strike_rate"), F.when(F.col("c") > 0, F.col("s") / F.col("c")).alias(f"avg_{speed_col}"))


def filter_options(cells: DataFrame, columns: Sequence[str]) -> DataFrame:
    """As ``summaries.filter_options_all``."""
    long = cells.select([F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "column", "value")
    return long.where(F.col("value").isNotNull()).distinct().orderBy("column", "value")


def shown_vs_total(cells: DataFrame, condition: Column) -> DataFrame:
    """As ``prep.shown_vs_total``; the condition is over dimensions."""
    return cells.agg(F.coalesce(F.sum(F.when(condition, F.col("n_rows"))), F.lit(0)).alias("n_shown"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_total"))


def zone_grid_scaled(cells: DataFrame, value: str = "count", min_rows: int = 0, n: int = 3) -> DataFrame:
    """As ``zones.zone_grid_scaled`` behind ``prep.min_rows_gate``, from the zone dimensions."""
    if value not in ("count", "prob"):
        raise ValueError("value must be 'count' or 'prob'")
    enough = cells.select(F.coalesce(F.sum("n_rows"), F.lit(0))).scalar() >= F.lit(min_rows)
    inside = cells.where(F.col("x_zone").isNotNull() & enough).groupBy("x_zone", "z_zone").agg(F.sum("n_rows").alias("n"), F.sum("n_labels").alias("n_labels"), F.sum("n_strikes").alias("n_strikes"))
    grid = cells.sparkSession.range(n * n).select((F.col("id") % n).cast("int").alias("x_zone"), F.floor(F.col("id") / n).cast("int").alias("z_zone"))
    full = grid.join(F.broadcast(inside), ["x_zone", "z_zone"], "left")  # at most n * n rows
    count = F.coalesce(F.col("n"), F.lit(0)).cast("long")
    val = count.cast("double") if value == "count" else F.coalesce(_rate(), F.lit(0.0))
    full = full.select(zone_number("x_zone", "z_zone", n, n).cast("int").alias("zone"), "x_zone", "z_zone", count.alias("n_pitches"), val.alias("value"))
    if value == "prob":
        return full.withColumn("scaled", F.col("value"))
    top = full.select(F.max("value")).scalar()
    return full.withColumn("scaled", F.col("value") / F.when(top > 0, top).otherwise(F.lit(1.0)))


def dashboard_cells(df: DataFrame) -> DataFrame:
    """The written cells of a pitch table for every panel: slice and zone dimensions, release speed."""
    df = with_zone(prep.derive_name(df))
    dims = [c for c in SLICE_DIMS if c in df.columns] + ZONE_DIMS
    return settled(slice_cells(df, dims), "slice-cells")
