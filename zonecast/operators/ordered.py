"""As-of joins and frame windows whose keys may be hot.

A plain window sends all rows of a key to one task.  Here the rows are range-partitioned by (key,
order), so a hot key falls into as many ranges as its share, and are written once with the number of
their range.  Inside a range only its first key can have earlier rows elsewhere, and only the last
key of an earlier range can be that key.  So one small row per range is enough to hand over what a
range needs from those before it: the last matched row (``asof_join``) or which ranges hold its last
rows (``rolling``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.session import settled

_KEY, _RANGE, _SIDE = "_key", "_range", "_side"


def _ranged(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows, range-partitioned by key and ``order`` and written with the number of their range."""
    return settled(rows.repartitionByRange(_KEY, *order).withColumn(_RANGE, F.spark_partition_id()), "ordered")


def _ends(ranged: DataFrame) -> DataFrame:
    """_range, first, last: the outer keys of each range (one row per range)."""
    return ranged.groupBy(_RANGE).agg(F.min(_KEY).alias("first"), F.max(_KEY).alias("last"))


def _struct(df: DataFrame, columns: Sequence[str]) -> Column:
    return F.struct(*[df[c].alias(c) for c in columns])


def _taken(give: DataFrame, ends: DataFrame, value: Column, name: str, frame) -> DataFrame:
    """_range, name: what each range takes over for its first key.

    ``give`` has one row per range (_range, last, ...); ``value`` is computed over ``frame`` of
    the rows of that key in ranges before.
    """
    take = ends.select(_RANGE, F.col("first").alias(_KEY), F.lit(0).alias("_gives"))
    both = give.withColumnRenamed("last", _KEY).withColumn("_gives", F.lit(1)).unionByName(take, allowMissingColumns=True)
    return both.withColumn(name, value.over(frame)).where("_gives = 0").select(_RANGE, name)


def asof_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str, left_by: Sequence[str] = (), right_by: Sequence[str] = (),
              *, ties: Sequence[str] = (), direction: str = "backward", allow_equal: bool = True, tolerance: Column | None = None,
              prefix: str = "right_", how: str = "left") -> DataFrame:
    """Each left row with the one right row of its key that is nearest in time before (``backward``) or after it (``forward``).

    ``ties`` orders right rows of one key and time: the last of them is taken backward, the first forward.
    Right columns are named with ``prefix``.  Beyond ``tolerance`` (a number or interval) there is no match.
    ``how="inner"`` leaves out rows without match.

    Null times or keys match nothing.  No key is gathered in one task, whichever side it is hot on.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(f"direction is backward or forward, not {direction}")
    if how not in ("left", "inner"):
        raise ValueError(f"how is left or inner, not {how}")
    back = direction == "backward"
    # at equal times the side that must be seen first comes first
    right_side = 0 if back == allow_equal else 2
    lkey = F.struct(*[left[c] for c in left_by]) if left_by else F.struct(F.lit(0))
    rkey = F.struct(*[right[c] for c in right_by]) if right_by else F.struct(F.lit(0))
    names = [f"k{i}" for i in range(max(1, len(left_by)))]
    kind = "struct<" + ", ".join(f"{n}:{left.schema[c].dataType.simpleString()}" for n, c in zip(names, left_by or [None])) + ">" if left_by else "struct<k0:int>"
    known = lambda df, by, on: [df[c].isNotNull() for c in [*by, on]]
    every = lambda tests: tests[0] if len(tests) == 1 else tests[0] & every(tests[1:])

    l_can, r_can = every(known(left, left_by, left_on)), every(known(right, right_by, right_on))
    lrow, rrow = _struct(left, left.columns), _struct(right, right.columns)
    ltype = left.select(lrow.alias("s")).schema["s"].dataType
    rtype = right.select(rrow.alias("s")).schema["s"].dataType
    tie = F.struct(*[right[c] for c in ties]) if ties else F.struct(F.lit(0).alias("none"))
    tie_type = right.select(tie.alias("t")).schema["t"].dataType
    on_type = left.schema[left_on].dataType
    ls = left.where(l_can).select(lkey.cast(kind).alias(_KEY), left[left_on].alias("_on"), F.lit(1).alias(_SIDE), F.lit(None).cast(tie_type).alias("_tie"), F.xxhash64(lrow).alias("_spread"), lrow.alias("_l"), F.lit(None).cast(rtype).alias("_r"))
    rs = right.where(r_can).select(rkey.cast(kind).alias(_KEY), right[right_on].cast(on_type).alias("_on"), F.lit(right_side).alias(_SIDE), tie.alias("_tie"), F.lit(0).cast("long").alias("_spread"), F.lit(None).cast(ltype).alias("_l"), rrow.alias("_r"))
    order = ["_on", _SIDE, "_tie", "_spread"]  # _spread: many left rows of one key and time still fall apart
    ranged = _ranged(ls.unionByName(rs), order)

    by = [F.col(c).asc() for c in order] if back else [F.col(c).desc() for c in order]
    here = Window.partitionBy(_RANGE, _KEY).orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    within = ranged.withColumn("_m", F.last("_r", ignorenulls=True).over(here)).where(F.col("_l").isNotNull())

    ends = _ends(ranged)
    if back:
        outer, reach = ends, F.max_by
    else:  # the same from the other end
        outer, reach = ends.select(_RANGE, F.col("last").alias("first"), F.col("first").alias("last")), F.min_by
    edge = ranged.where(F.col("_r").isNotNull()).join(F.broadcast(outer.select(_RANGE, "last")), _RANGE).where(F.col(_KEY) == F.col("last"))
    give = edge.groupBy(_RANGE, "last").agg(reach("_r", F.struct(*order)).alias("_give"))
    turn = F.col(_RANGE).asc() if back else F.col(_RANGE).desc()
    frame = Window.partitionBy(_KEY).orderBy(turn, "_gives").rowsBetween(Window.unboundedPreceding, 0)
    taken = _taken(give, outer, F.last("_give", ignorenulls=True), "_carry", frame)
    taken = taken.join(outer.select(_RANGE, F.col("first").alias("_first")), _RANGE)

    found = within.join(F.broadcast(taken), _RANGE, "left")  # one row per range
    match = F.coalesce("_m", F.when(F.col(_KEY) == F.col("_first"), F.col("_carry")))
    out = found.select("_l", match.alias("_m"))
    if tolerance is not None:
        at, to = F.col("_l")[left_on], F.col("_m")[right_on].cast(on_type)
        out = out.withColumn("_m", F.when((at - to if back else to - at) <= tolerance, F.col("_m")))
    if how == "inner":
        out = out.where(F.col("_m").isNotNull())
    else:
        out = out.unionByName(left.where(~l_can).select(lrow.alias("_l"), F.lit(None).cast(rtype).alias("_m")))
    return out.select(*[F.col("_l")[c].alias(c) for c in left.columns], *[F.col("_m")[c].alias(f"{prefix}{c}") for c in right.columns])


def rolling(df: DataFrame, by: Sequence[str], order: Sequence[str], rows: int, aggs: Mapping[str, Column]) -> DataFrame:
    """Aggregates over each row and the ``rows - 1`` before it of its key, in ascending ``order``.

    ``order`` must tell the rows of a key apart, or the frame is one of several possible ones; nulls come
    first, and a null key is a key.  The last ``rows - 1`` rows of each range's last key are copied into the ranges
    that need them, so a hot key is computed by as many tasks as it has ranges.
    """
    if rows < 1:
        raise ValueError("a frame has one row at least")
    base = df.select("*", F.struct(*[F.col(c) for c in by]).alias(_KEY) if by else F.struct(F.lit(0)).alias(_KEY))
    ranged = _ranged(base, order).withColumn("_copy", F.lit(False))
    if rows > 1:
        ends = _ends(ranged)
        edge = ranged.join(F.broadcast(ends.select(_RANGE, F.col("last").alias("_last"))), _RANGE).where(F.col(_KEY).eqNullSafe(F.col("_last"))).drop("_last")
        counts = edge.groupBy(_RANGE, _KEY).agg(F.count(F.lit(1)).alias("_n")).withColumnRenamed(_KEY, "last")
        # a range's place is the number of its key's rows up to its end; a range that takes stands where those before it end
        takes = ends.select(_RANGE, F.col("first").alias(_KEY), F.lit(0).cast("long").alias("_n"), F.lit(0).alias("_gives"))
        both = counts.withColumnRenamed("last", _KEY).withColumn("_gives", F.lit(1)).unionByName(takes)
        upto = Window.partitionBy(_KEY).orderBy(_RANGE, "_gives").rowsBetween(Window.unboundedPreceding, 0)
        near = Window.partitionBy(_KEY).orderBy("_upto").rangeBetween(-(rows - 2), 0)
        feeds = both.withColumn("_upto", F.sum("_n").over(upto)).withColumn("_from", F.collect_list(F.when(F.col("_gives") == 1, F.col(_RANGE))).over(near))
        # at most rows - 1 ranges, as each has a row of the key
        feeds = feeds.where("_gives = 0").select(F.col(_RANGE).alias("_to"), F.explode("_from").alias(_RANGE)).where(F.col(_RANGE) < F.col("_to"))
        last = Window.partitionBy(_RANGE).orderBy(*[F.col(c).desc() for c in order])
        tails = edge.withColumn("_place", F.row_number().over(last)).where(F.col("_place") < rows).drop("_place")
        copies = tails.join(feeds, _RANGE).withColumn(_RANGE, F.col("_to")).withColumn("_copy", F.lit(True)).drop("_to")
        ranged = ranged.unionByName(copies)
    frame = Window.partitionBy(_RANGE, _KEY).orderBy(*order).rowsBetween(-(rows - 1), 0)
    return ranged.select(*df.columns, "_copy", *[a.over(frame).alias(n) for n, a in aggs.items()]).where("not _copy").drop("_copy")
