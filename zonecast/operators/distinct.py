"""Exact distinct counts that can be merged: one bitmap per group and block of 32,768 ids.

Bitmaps of days, files or cells are united by ``or``, so a count of distinct ids at any coarser level comes
from them without the rows.  A hot group is as many rows as it has id blocks, none of them over 4 KB.
Ids should be dense (row numbers, surrogate keys); ``dense_codes`` numbers the values of any other column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.operators.selection import ordered_prefix_sums


def id_bitmaps(df: DataFrame, dims: Sequence[str], id_col: str) -> DataFrame:
    """dims, block, bitmap.  Null ids count nowhere; a null dimension is a value."""
    known = df.where(F.col(id_col).isNotNull())
    blocks = known.select(*dims, F.bitmap_bucket_number(F.col(id_col).cast("long")).alias("block"), F.bitmap_bit_position(F.col(id_col).cast("long")).alias("_bit"))
    return blocks.groupBy(*dims, "block").agg(F.bitmap_construct_agg("_bit").alias("bitmap"))


def merged_bitmaps(bitmaps: DataFrame, dims: Sequence[str] = ()) -> DataFrame:
    """The same at a coarser level, or of several tables in a union."""
    return bitmaps.groupBy(*dims, "block").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_counts(bitmaps: DataFrame, dims: Sequence[str] = (), name: str = "n_distinct") -> DataFrame:
    """dims, distinct ids; without dims one row."""
    ones = F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).cast("long").alias(name)
    level = merged_bitmaps(bitmaps, dims)
    return level.groupBy(*dims).agg(ones) if dims else level.agg(ones)


def dense_codes(df: DataFrame, col: str) -> DataFrame:
    """col, code: the distinct values numbered from 1 in ascending order, without one task for all (null has none)."""
    values = df.select(col).where(F.col(col).isNotNull()).distinct().withColumn("_one", F.lit(1).cast("long"))
    return ordered_prefix_sums(values, col, ["_one"], prefix="code").select(col, F.col("code_one").alias("code"))
