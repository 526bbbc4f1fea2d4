"""Approximate quantiles from sketches that can be kept and merged.

A column of KLL sketches, one per day and type, answers quantiles over any range of days by merging a few
kilobytes a row.  The exact operators (``selection``) stay the default; this is for tables too large to read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 400


def rank_error(k: int = K) -> float:
    """How far a quantile's true rank (0 to 1) may be from the wanted one, in 99 of 100 cases (published for KLL sketches)."""
    return 2.296 / k**0.9723


def quantile_sketches(df: DataFrame, dims: Sequence[str], value_col: str, k: int = K) -> DataFrame:
    """dims, sketch.  Null and NaN values take no part; a group without values has no row."""
    v = F.col(value_col).cast("double")
    known = df.select(*dims, v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    return known.groupBy(*dims).agg(F.kll_sketch_agg_double("_v", k).alias("sketch"))


def merged_sketches(sketches: DataFrame, dims: Sequence[str] = ()) -> DataFrame:
    """The same at a coarser level, or of several tables in a union."""
    return sketches.groupBy(*dims).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, probs: Sequence[float]) -> DataFrame:
    """The other columns, n (values), prob, quantile."""
    rest = [c for c in sketches.columns if c != "sketch"]
    rows = F.array(*[F.struct(F.lit(float(p)).alias("prob"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("quantile")) for p in probs])
    return sketches.select(*rest, F.kll_sketch_get_n_double("sketch").alias("n"), F.explode(rows).alias("q")).select(*rest, "n", "q.prob", "q.quantile")
