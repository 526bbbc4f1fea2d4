"""A file layout in which slices and date ranges read few files.

Rows are placed on a bit-interleaved (Z-order) curve over the rank buckets of several columns, range-partitioned by it and
sorted, so every file covers a small box of all the columns.  The minima and maxima that Parquet keeps
per file then let any filter on one or several of them skip the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 8


def _number(df: DataFrame, c: str) -> Column:
    kind = df.schema[c].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("double")
    return F.col(c).cast("double")


def rank_buckets(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> list[Column]:
    """Per column a whole number below 2^bits: which part of the column's rows the value is in (null first).

    Bounds are approximate quantiles (at most 2^bits - 1 numbers a column reach the driver).  Text is placed by its
    first six bytes, which keeps its order.
    """
    n = 1 << bits
    values = []
    for c in columns:
        if isinstance(df.schema[c].dataType, T.StringType):
            head = F.rpad(F.hex(F.substring(F.col(c).cast("binary"), 1, 6)), 12, "0")
            values.append(F.conv(head, 16, 10).cast("double"))
        else:
            values.append(_number(df, c))
    cuts = df.agg(*[F.percentile_approx(v, [i / n for i in range(1, n)], 10 * n).alias(f"c{i}") for i, v in enumerate(values)]).first()
    out = []
    for i, v in enumerate(values):
        bounds = sorted({float(x) for x in cuts[f"c{i}"] or []})
        place = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= v)) if bounds else F.lit(0)
        place = F.floor(place * F.lit(n) / F.lit(len(bounds) + 1))  # few values use the highest bits, too
        out.append(F.when(v.isNull() | F.isnan(v), 0).otherwise(place))
    return out


def z_value(buckets: Sequence[Column], bits: int = BITS) -> Column:
    """The buckets' bits, interleaved from the highest down (at most 63 in all)."""
    if len(buckets) * bits > 63:
        raise ValueError("columns times bits is at most 63")
    z, at = F.lit(0).cast("long"), len(buckets) * bits
    for b in reversed(range(bits)):
        for c in buckets:
            at -= 1
            z = z.bitwiseOR(F.shiftleft(F.shiftright(c.cast("long"), b).bitwiseAND(F.lit(1).cast("long")), at))
    return z


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int, bits: int = BITS) -> None:
    """Write ``files`` parquet files (about) clustered by ``columns``; replaces what is there.

    Rows of one curve value (equal in all columns' buckets) are spread by a hash, so a frequent slice is several files.
    """
    spread = F.xxhash64(*df.columns)
    keyed = df.withColumn("_z", z_value(rank_buckets(df, columns, bits), bits)).withColumn("_s", spread)
    keyed.repartitionByRange(files, "_z", "_s").sortWithinPartitions("_z", *columns).drop("_z", "_s").write.mode("overwrite").parquet(path)
