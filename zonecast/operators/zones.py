"""Plate-location binning: heatmaps, the 3x3 rule-book grid, speed histograms.

Bounds are one-row aggregates used as scalar subqueries (computed once, no
cross join); per-class bounds are a broadcast of one counted row per class.  Cells are
partial-aggregated, so hot cells never skew a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast import schema as S
from zonecast.functions import uniform_bin, zone_number
from zonecast.session import settled

LABEL = "is_strike"
MAX_BROADCAST_CLASSES = 200_000  # three numbers a class


def zone_heatmap(df: DataFrame, bins: int = 20, x_col: str = "plate_x", z_col: str = "plate_z",
                 label_col: str = LABEL) -> DataFrame:
    """Mean label per (x_bin, z_bin) cell; bins are equal-width from each axis' min to max,
    right-closed with the lowest value included; an axis with a single value takes its
    middle bin.  Cells with no rows are absent, so an empty input gives an empty frame.

    Output: x_bin, z_bin, n_pitches, strike_prob.
    """
    S.require_columns(df, [x_col, z_col, label_col], "heatmap input")
    # the four bounds are scalar subqueries over one shared aggregate, so building the plan runs no job
    bound = lambda f, c: df.agg(f(c).cast("double").alias("v")).scalar()
    cells = (df.select(F.col(x_col).alias("_x"), F.col(z_col).alias("_z"), F.col(label_col).alias("_y"),
                       bound(F.min, x_col).alias("_x_lo"), bound(F.max, x_col).alias("_x_hi"),
                       bound(F.min, z_col).alias("_z_lo"), bound(F.max, z_col).alias("_z_hi"))
             .select(uniform_bin("_x", F.col("_x_lo"), F.col("_x_hi"), bins, "right").alias("x_bin"),
                     uniform_bin("_z", F.col("_z_lo"), F.col("_z_hi"), bins, "right").alias("z_bin"), "_y")
             .filter(F.col("x_bin").isNotNull() & F.col("z_bin").isNotNull()))
    return cells.groupBy("x_bin", "z_bin").agg(F.count(F.lit(1)).alias("n_pitches"),
                                               F.avg("_y").alias("strike_prob"))


def zone_heatmap_dense(df: DataFrame, bins: int = 20, **kw) -> DataFrame:
    """Heatmap over every observed x_bin x observed z_bin, empty cells 0.

    Built as pivot (z bins become columns, at most ``bins``) then unpivot, so the
    grid is completed without a cross join.  Output: x_bin, z_bin, strike_prob.
    """
    cells = settled(zone_heatmap(df, bins, **kw), "heatmap-cells")  # at most bins * bins rows; the source is read once
    z_seen = [r[0] for r in cells.select("z_bin").distinct().orderBy("z_bin").collect()]  # <= bins values
    wide = cells.groupBy("x_bin").pivot("z_bin", z_seen).agg(F.first("strike_prob"))
    names = [str(z) for z in z_seen]
    if not names:
        return cells.select("x_bin", "z_bin", "strike_prob")
    wide = wide.select("x_bin", *[F.coalesce(F.col(f"`{n}`"), F.lit(0.0)).alias(f"z{n}") for n in names])
    long = wide.unpivot(["x_bin"], [f"z{n}" for n in names], "_z", "strike_prob")
    return long.select("x_bin", F.substring("_z", 2, 10).cast("int").alias("z_bin"), "strike_prob")


def zone_grid(df: DataFrame, value: str = "count", x_col: str = "plate_x", z_col: str = "plate_z",
              label_col: str = LABEL, nx: int = 3, nz: int = 3) -> DataFrame:
    """Rule-book zone split into nx x nz cells; rows outside the zone are dropped.

    ``value='count'`` gives pitches per cell, ``'prob'`` the mean label; empty
    cells are 0.  Output: zone (1 = top-left), x_zone, z_zone, n_pitches, value.
    """
    if value not in ("count", "prob"):
        raise ValueError("value must be 'count' or 'prob'")
    S.require_columns(df, [x_col, z_col, label_col], "zone grid input")
    xl, xh, zl, zh = (F.lit(S.ZONE_LEFT), F.lit(S.ZONE_RIGHT), F.lit(S.ZONE_BOTTOM), F.lit(S.ZONE_TOP))
    x, z = F.col(x_col), F.col(z_col)
    xi = F.when(x.between(xl, xh), uniform_bin(x, xl, xh, nx, "right"))
    zi = F.when(z.between(zl, zh), uniform_bin(z, zl, zh, nz, "right"))
    cells = (df.select(xi.alias("x_zone"), zi.alias("z_zone"), F.col(label_col).alias("_y"))
             .filter(F.col("x_zone").isNotNull() & F.col("z_zone").isNotNull())
             .groupBy("x_zone", "z_zone")
             .agg(F.count(F.lit(1)).alias("n_pitches"), F.avg("_y").alias("_p")))
    spark = df.sparkSession
    grid = spark.range(nx * nz).select((F.col("id") % nx).cast("int").alias("x_zone"),
                                       (F.col("id") / nx).cast("int").alias("z_zone"))
    full = grid.join(F.broadcast(cells), on=["x_zone", "z_zone"], how="left")  # cells: at most nx*nz rows
    n = F.coalesce(F.col("n_pitches"), F.lit(0)).cast("long")
    val = n.cast("double") if value == "count" else F.coalesce(F.col("_p"), F.lit(0.0))
    return full.select(zone_number("x_zone", "z_zone", nx, nz).cast("int").alias("zone"), "x_zone", "z_zone",
                       n.alias("n_pitches"), val.alias("value"))


def zone_grid_scaled(df: DataFrame, value: str = "count", **kw) -> DataFrame:
    """Grid values on the colour scale: prob is already 0..1; count is divided by the
    largest cell (1 when every cell is empty).  The window spans the 9 grid rows only."""
    g = zone_grid(df, value, **kw)
    if value == "prob":
        return g.withColumn("scaled", F.col("value"))
    vmax = F.max("value").over(Window.partitionBy())
    top = F.when(vmax > 0, vmax).otherwise(F.lit(1.0))
    return g.withColumn("scaled", F.col("value") / top)


def speed_histogram(df: DataFrame, value_col: str = "release_speed", class_col: str = LABEL,
                    bins: int = 30) -> DataFrame:
    """Histogram per class, each class binned over its own min..max (left-closed bins,
    the last closed; min == max widens by 0.5 each side).  Empty bins are absent.

    Output: class, bin, bin_lo, bin_hi, n.
    """
    v = F.col(value_col)
    base = df.filter(v.isNotNull() & ~F.isnan(v) if isinstance(df.schema[value_col].dataType, T.DoubleType)
                     else v.isNotNull())
    bounds = base.groupBy(class_col).agg(F.min(v).cast("double").alias("_lo"), F.max(v).cast("double").alias("_hi"))
    bounds = bounds.select(class_col,
                           F.when(F.col("_lo") == F.col("_hi"), F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"),
                           F.when(F.col("_lo") == F.col("_hi"), F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("_hi"))
    # one row per class: broadcast while counted small, so the class key is never shuffled before the partial aggregate
    bounds = settled(bounds.withColumnRenamed(class_col, "_class"), "class-bounds")
    small = bounds.count() <= MAX_BROADCAST_CLASSES
    j = base.select(class_col, v.cast("double").alias("_v")).join(
        F.broadcast(bounds) if small else bounds, F.col(class_col) == F.col("_class"), "inner")
    lo, hi = F.col("_lo"), F.col("_hi")
    binned = j.select(class_col, uniform_bin("_v", lo, hi, bins, "left").alias("bin"), lo, hi)
    agg = binned.groupBy(class_col, "bin").agg(F.count(F.lit(1)).alias("n"), F.first("_lo").alias("_lo"),
                                               F.first("_hi").alias("_hi"))
    step = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    edge = lambda i: F.when(i >= bins, F.col("_hi")).otherwise(i.cast("double") * step + F.col("_lo"))
    return agg.select(class_col, "bin", edge(F.col("bin")).alias("bin_lo"), edge(F.col("bin") + 1).alias("bin_hi"), "n")
