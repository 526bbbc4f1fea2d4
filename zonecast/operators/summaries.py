"""Group-by summaries behind the overview panels and EDA tables.

Every grouping aggregates map-side first (partial aggregation), so a hot group
costs one partial row per task, not a skewed shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.operators.selection import column_quantiles, exact_quantiles

LABEL = "is_strike"
MAX_MATRIX_COLUMNS = 1000


def overview_totals(df: DataFrame, label_col: str = LABEL) -> DataFrame:
    """(n_pitches, n_strikes, n_balls, strike_rate) in one aggregate."""
    y = F.col(label_col)
    n = F.count(F.lit(1))
    s = F.sum(y).cast("long")
    return df.agg(n.alias("n_pitches"), s.alias("n_strikes"), (n - s).alias("n_balls"),
                  F.avg(y).alias("strike_rate"))


def rate_by(df: DataFrame, group_col: str, label_col: str = LABEL, digits: int | None = None) -> DataFrame:
    """Count and mean of the label per group, highest rate first; null group dropped."""
    rate = F.avg(label_col)
    if digits is not None:
        rate = F.bround(rate, digits)
    return (df.filter(F.col(group_col).isNotNull())
            .groupBy(group_col)
            .agg(F.count(F.lit(1)).alias("n_pitches"), rate.alias("strike_rate"))
            .orderBy(F.desc("strike_rate"), F.asc(group_col)))


def rate_by_count(df: DataFrame, balls_col: str = "balls", strikes_col: str = "strikes",
                  label_col: str = LABEL, digits: int = 3) -> DataFrame:
    """Total, strikes and rate per (balls, strikes), sorted by the count; rate rounded half-even."""
    return (df.filter(F.col(balls_col).isNotNull() & F.col(strikes_col).isNotNull())
            .groupBy(balls_col, strikes_col)
            .agg(F.count(F.lit(1)).alias("total"), F.sum(label_col).cast("long").alias("strikes_n"),
                 F.bround(F.avg(label_col), digits).alias("strike_rate"))
            .orderBy(balls_col, strikes_col))


def rate_by_count_label(df: DataFrame, balls_col: str = "balls", strikes_col: str = "strikes",
                        label_col: str = LABEL, min_rows: int = 10) -> DataFrame:
    """Rate per "balls-strikes" label, groups with at least ``min_rows`` rows, ordered by
    the parsed parts of the label."""
    lab = F.concat_ws("-", F.col(balls_col).cast("string"), F.col(strikes_col).cast("string"))
    g = (df.filter(F.col(balls_col).isNotNull() & F.col(strikes_col).isNotNull())
         .groupBy(lab.alias("count_label"))
         .agg(F.count(F.lit(1)).alias("n_pitches"), F.avg(label_col).alias("strike_rate"))
         .filter(F.col("n_pitches") >= min_rows))
    parts = F.split("count_label", "-")
    return (g.withColumn("balls_sort", parts.getItem(0).cast("int"))
            .withColumn("strikes_sort", parts.getItem(1).cast("int"))
            .orderBy("balls_sort", "strikes_sort"))


def count_matrix(df: DataFrame, row_col: str = "balls", col_col: str = "strikes", label_col: str = LABEL,
                 values: Sequence | None = None, prefix: str | None = None) -> DataFrame:
    """Mean label pivoted rows x columns, missing cells 0.  Columns are named
    ``<col_col>_<value>``.  Pass ``values`` to skip the distinct-values job; without
    them more than ``MAX_MATRIX_COLUMNS`` distinct values raise, as a result can't have that many columns."""
    prefix = prefix or f"{col_col}_"
    base = df.filter(F.col(row_col).isNotNull() & F.col(col_col).isNotNull())
    if values is None:
        values = [r[0] for r in base.select(col_col).distinct().orderBy(col_col).limit(MAX_MATRIX_COLUMNS + 1).collect()]
        if len(values) > MAX_MATRIX_COLUMNS:
            raise ValueError(f"{col_col} has more than {MAX_MATRIX_COLUMNS} values; pass the wanted ones")
    p = base.groupBy(row_col).pivot(col_col, list(values)).agg(F.avg(label_col))
    cells = p.columns[len(p.columns) - len(values):]  # in the order of ``values``
    renamed = p.select(row_col, *[F.coalesce(F.col("`" + c.replace("`", "``") + "`"), F.lit(0.0)).alias(f"{prefix}{v}")
                                  for c, v in zip(cells, values)])
    return renamed.orderBy(row_col)


def value_counts(df: DataFrame, col: str, by: str = "count") -> DataFrame:
    """Non-null value counts, sorted by count desc (``by='count'``) or by value."""
    g = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return g.orderBy(F.desc("n"), F.asc(col)) if by == "count" else g.orderBy(col)


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n_missing) for columns with any missing value; NaN counts as missing."""
    columns = list(columns or df.columns)
    exprs = []
    for c in columns:
        dt = df.schema[c].dataType
        miss = F.col(c).isNull()
        if isinstance(dt, (T.DoubleType, T.FloatType)):
            miss = miss | F.isnan(c)
        exprs.append(F.count_if(miss).alias(c))
    wide = df.agg(*exprs)
    long = wide.unpivot([], columns, "column", "n_missing")
    return long.filter(F.col("n_missing") > 0)


def describe_by_class(df: DataFrame, value_col: str = "release_speed", class_col: str = LABEL) -> DataFrame:
    """count, mean, std (n-1), min, q25, median, q75, max of a column per class.

    Moments come from one partial aggregate; quartiles from the exact
    distributed selection (no class is gathered into one task).
    """
    v = F.col(value_col)
    ok = v.isNotNull() & ~F.isnan(v) if isinstance(df.schema[value_col].dataType, (T.DoubleType, T.FloatType)) \
        else v.isNotNull()
    base = df.filter(ok)
    moments = base.groupBy(class_col).agg(
        F.count(F.lit(1)).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).cast("double").alias("min"), F.max(v).cast("double").alias("max"))
    q = exact_quantiles(base, value_col, [0.25, 0.5, 0.75], [class_col])
    pick = {name: F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(name)
            for name, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))}
    qw = q.groupBy(F.col(class_col).alias("_class")).agg(*pick.values())
    return moments.join(qw, F.col(class_col).eqNullSafe(F.col("_class")), "left").select(
        class_col, "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def filter_options(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values, sorted."""
    return df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col)


def filter_options_all(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) option lists for several string-able columns in one pass."""
    long = df.select([F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "column", "value")
    return long.filter(F.col("value").isNotNull()).distinct().orderBy("column", "value")


def median_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, median) for each column; exact and interpolated, computed together."""
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    found = column_quantiles(df, columns).select("column", F.col("quantile").alias("median"))
    return names.join(found, "column", "left")


def slice_summary(df: DataFrame, label_col: str = LABEL, speed_col: str = "release_speed") -> DataFrame:
    """Rows, strike rate and mean release speed of a slice."""
    return df.agg(F.count(F.lit(1)).alias("n_pitches"), F.avg(label_col).alias("strike_rate"),
                  F.avg(speed_col).alias("avg_release_speed"))


def axis_extents(df: DataFrame, x_col: str = "plate_x", z_col: str = "plate_z") -> DataFrame:
    return df.agg(F.min(x_col).alias("x_min"), F.max(x_col).alias("x_max"),
                  F.min(z_col).alias("z_min"), F.max(z_col).alias("z_max"))


def split_balance(df: DataFrame, split_col: str = "split", label_col: str = LABEL) -> DataFrame:
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n_rows"), F.avg(label_col).alias("strike_rate"))

