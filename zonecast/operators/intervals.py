"""Joins of intervals (or points) that overlap, by buckets instead of a nested loop.

The axis is cut into buckets of one width, and every row goes to each bucket it touches, so an
equality joins the sides.  A pair may meet in several buckets and counts in the first that both touch.
A long interval would touch very many buckets: rows longer than ``SPREAD`` widths use buckets ``SPREAD`` times
as wide (and so on, level by level), and a pair meets on the coarser of its two levels.  The width is the mean
length, so a side grows by a small factor whatever its lengths are, and no row touches more than
``SPREAD + 2`` buckets of a level.  In a coarse bucket only rows of that level meet others: two short rows
are never compared there.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.session import settled

SPREAD = 64


def _number(c: Column, kind: T.DataType) -> Column:
    """The axis as a double (timestamps in microseconds, dates in days); it only picks buckets."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        day = F.unix_date(F.to_date(c)).cast("double") * 86_400_000_000.0  # no time zone takes part
        return day + (F.hour(c) * 3600 + F.minute(c) * 60) * 1e6 + F.extract(F.lit("SECOND"), c).cast("double") * 1e6
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    return c.cast("double")


def _prepared(df: DataFrame, on: str | Sequence[str], by: Sequence[str], side: str) -> DataFrame:
    """The row as a struct, its key, its ends and their numbers; rows that can't match are left out."""
    low, high = (on, on) if isinstance(on, str) else on
    out = df.select(F.struct(*[df[c].alias(c) for c in df.columns]).alias(side), F.struct(*[df[c] for c in by] or [F.lit(0)]).alias("key"),
                    df[low].alias("low"), df[high].alias("high"), _number(df[low], df.schema[low].dataType).alias("a"), _number(df[high], df.schema[high].dataType).alias("b"))
    fits = (F.col("low") <= F.col("high")) & ~F.isnan("a") & ~F.isnan("b")
    for c in by:
        fits = fits & F.col(side)[c].isNotNull()
    return out.where(fits)


def _extent(rows: DataFrame) -> DataFrame:
    real = F.abs("a") != float("inf"), F.abs("b") != float("inf")
    return rows.agg(F.min(F.when(real[0], F.col("a"))).alias("least"), F.max(F.when(real[1], F.col("b"))).alias("most"),
                    F.sum(F.when(real[0] & real[1], F.col("b") - F.col("a"))).alias("total"), F.count(F.lit(1)).alias("n"),
                    F.max(F.nanvl(F.col("b") - F.col("a"), F.lit(0.0))).alias("longest"))


def _placed(rows: DataFrame, least: float, most: float, width: float, levels: int, names: tuple[str, str, str]) -> DataFrame:
    """One row per bucket of the row's own level and of every coarser one; ends beyond the other rows are cut off."""
    own, first, keep = names
    inside = lambda c: F.least(F.greatest(F.col(c), F.lit(least)), F.lit(most)) - F.lit(least)
    rows = rows.withColumn("a", inside("a")).withColumn("b", inside("b"))
    level = sum((((F.col("b") - F.col("a")) > width * SPREAD ** (k + 1)).cast("int") for k in range(levels - 1)), F.lit(0))
    rows = rows.withColumn(own, level)
    at = lambda c, k: F.floor(F.col(c) / F.lit(width * SPREAD**k))
    spans = F.array(*[F.struct(F.lit(k).alias("level"), at("a", k).alias("from"), at("b", k).alias("to")) for k in range(levels)])
    some = rows.select(keep, "key", "low", "high", own, F.explode(F.filter(spans, lambda s: s["level"] >= F.col(own))).alias("s"))
    return some.select(keep, "key", "low", "high", own, F.col("s.level").alias("level"), F.col("s.from").alias(first), F.explode(F.sequence("s.from", "s.to")).alias("bucket"))


def _met(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that share a bucket of the coarser of their levels: the left row's own (``by_right`` 0) or else the right one's (1)."""
    a = a.withColumn("by_right", (F.col("level") > F.col("own_l")).cast("int"))
    own = F.col("level") == F.col("own_r")
    b = b.withColumn("by_right", F.explode(F.when(own, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return a.join(b, ["key", "level", "bucket", "by_right"])


def interval_join(left: DataFrame, right: DataFrame, left_on: str | Sequence[str], right_on: str | Sequence[str],
                  left_by: Sequence[str] = (), right_by: Sequence[str] = (), *, closed: str = "both", how: str = "inner",
                  prefix: str = "right_") -> DataFrame:
    """Pairs of rows of one key whose intervals share a point.

    ``*_on`` is a column (a point) or a pair of columns (low, high).  ``closed="both"``: ends belong to the interval;
    ``"left"``: the high end of an interval doesn't (a point still is one).  ``how="left"`` also keeps left rows
    without partner.  Right columns are named with ``prefix``.

    Null or NaN ends, null keys and intervals whose low is above their high match nothing; infinite ends are allowed.
    """
    if closed not in ("both", "left") or how not in ("inner", "left"):
        raise ValueError("closed is both or left, how is inner or left")
    if how == "left":  # written, so that the numbers of rows stay the same
        left = settled(left.withColumn("_row", F.monotonically_increasing_id()), "interval-left")
    l_rows, r_rows = _prepared(left, left_on, left_by, "_l"), _prepared(right, right_on, right_by, "_r")
    stats = _extent(l_rows).unionByName(_extent(r_rows)).collect()  # two rows
    ends = [(s["least"], s["most"]) for s in stats]
    least = min([e[0] for e in ends if e[0] is not None], default=0.0)
    most = max([least, *[e[1] for e in ends if e[1] is not None]])
    n = sum(s["n"] for s in stats)
    longest = most - least
    # points have no length: about one of them a bucket then
    width = max([(s["total"] or 0) / s["n"] for s in stats if s["n"]] + [longest / (n + 1), 1e-9 * longest]) or 1.0
    row = min(longest, max([s["longest"] for s in stats if s["n"]], default=0.0))  # an infinite one is as long as the axis
    levels = 1 + max(0, math.ceil(math.log(max(row / width, 1), SPREAD)) - 1)
    a = _placed(l_rows, least, most, width, levels, ("own_l", "first_l", "_l"))
    b = _placed(r_rows, least, most, width, levels, ("own_r", "first_r", "_r"))
    a = a.withColumnsRenamed({"low": "low_l", "high": "high_l"})
    b = b.withColumnsRenamed({"low": "low_r", "high": "high_r"})
    met = _met(a, b).where("bucket = greatest(first_l, first_r)")
    point_l, point_r = F.lit(isinstance(left_on, str)), F.lit(isinstance(right_on, str))
    if closed == "both":
        meets = (F.col("low_l") <= F.col("high_r")) & (F.col("low_r") <= F.col("high_l"))
    else:
        before = lambda low, high, point: (F.col(low) < F.col(high)) | (point & (F.col(low) <= F.col(high)))
        real_l, real_r = point_l | (F.col("low_l") < F.col("high_l")), point_r | (F.col("low_r") < F.col("high_r"))
        meets = before("low_l", "high_r", point_r) & before("low_r", "high_l", point_l) & real_l & real_r
    pairs = met.where(meets).select("_l", "_r")
    if how == "left":
        have = pairs.select(F.col("_l._row").alias("_row")).distinct()
        alone = left.join(have, "_row", "left_anti").select(*left.columns)
        lone = alone.select(F.struct(*[F.col(c) for c in left.columns]).alias("_l"), F.lit(None).cast(pairs.schema["_r"].dataType).alias("_r"))
        pairs = pairs.unionByName(lone)
    return pairs.select(*[F.col("_l")[c].alias(c) for c in left.columns if c != "_row"], *[F.col("_r")[c].alias(f"{prefix}{c}") for c in right.columns])
