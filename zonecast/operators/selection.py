"""Exact order statistics and ordered running sums as plans, without a group in one task.

Spark's exact ``percentile``/``median`` aggregate buffers every distinct value of
a group in one task, and ``row_number()`` over ``PARTITION BY label`` sends half
the table to one task.  The operators here rest on one primitive instead:

``ordered_prefix_sums`` first reduces to one row per (group, value), range-
partitions those rows by (group, value) - a hot group falls into as many ranges
as its share of the rows - and writes them once to the shared folder with the
number of their range.  Sums inside a range, plus the totals of the group's
ranges before it, are running sums in the global order.

* ``exact_quantiles`` looks the wanted ranks up in the running counts.
* ``cutoff_keys`` (stratified splits) counts rows by a 16-bit prefix of a hash,
  finds the prefix in which each group's k-th key lies, and ranks only the keys
  of that prefix.

The number of groups, of ranks, or of distinct values has no limit, and the
driver sees none of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.session import settled

_KEY = "_grp"


def _group_key(gcols: Sequence[str]):
    return F.struct(*[F.col(c) for c in gcols]) if gcols else F.struct(F.lit(0).alias("_c"))


def ordered_prefix_sums(df: DataFrame, order_col: str, sum_cols: Sequence[str],
                        partition_cols: Sequence[str] = (), *, prefix: str = "cum_") -> DataFrame:
    """Inclusive running sums of ``sum_cols`` in ascending ``order_col`` (per partition).

    ``df`` has one row per (partition, order value).  Nulls in the partition
    columns form a partition of their own; the order column keeps its type.
    """
    key = _group_key(partition_cols)
    keyed = df.withColumn(_KEY, key).repartitionByRange(_KEY, order_col)
    ranged = settled(keyed.withColumn("_range", F.spark_partition_id()), "ranges")
    totals = ranged.groupBy(_KEY, "_range").agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    before = Window.partitionBy(_KEY).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(_KEY, "_range", *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}")
                                              for c in sum_cols])
    upto = Window.partitionBy(_KEY, "_range").orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    within = ranged.select("*", *[F.sum(c).over(upto).alias(f"_w_{c}") for c in sum_cols])
    joined = within.join(offsets, on=[_KEY, "_range"], how="inner")
    return joined.select(*df.columns, *[(F.col(f"_w_{c}") + F.col(f"_o_{c}")).alias(f"{prefix}{c}")
                                        for c in sum_cols])


def exact_quantiles(df: DataFrame, value_col: str, probs: Sequence[float],
                    group_cols: Sequence[str] = ()) -> DataFrame:
    """Exact linear-interpolated quantiles (pandas / DuckDB ``quantile_cont``).

    Nulls and NaN are ignored (infinities order as values).  Output: group
    columns, ``prob``, ``quantile`` and ``n`` (non-missing rows); a group
    without values has no row.
    """
    gcols = list(group_cols)
    dt = df.schema[value_col].dataType
    integral = isinstance(dt, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    v = F.col(value_col).cast("long" if integral else "double")
    ok = v.isNotNull() if integral else (v.isNotNull() & ~F.isnan(v))
    counts = df.select(_group_key(gcols).alias("_g"), v.alias("_v")).filter(ok) \
        .groupBy("_g", "_v").agg(F.count(F.lit(1)).alias("_c"))
    cum = ordered_prefix_sums(counts, "_v", ["_c"], ["_g"], prefix="_upto")
    sizes = cum.groupBy("_g").agg(F.max("_upto_c").alias("n"))
    ranked = cum.join(sizes, "_g")
    first, last = F.col("_upto_c") - F.col("_c"), F.col("_upto_c") - 1  # ranks that hold this value

    def at(rank):
        return F.max(F.when((first <= rank) & (rank <= last), F.col("_v").cast("double")))

    pos = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    got = ranked.groupBy("_g").agg(F.max("n").alias("n"), *[e for i, x in enumerate(pos) for e in (
        at(F.floor(x)).alias(f"_a{i}"), at(F.ceil(x)).alias(f"_b{i}"))])
    rows = [F.struct(F.lit(float(p)).alias("prob"), F.when(F.col(f"_a{i}") == F.col(f"_b{i}"), F.col(f"_a{i}")).otherwise(
        F.col(f"_a{i}") + (F.col(f"_b{i}") - F.col(f"_a{i}")) * (pos[i] - F.floor(pos[i]))).alias("quantile"))
        for i, p in enumerate(probs)]
    out = got.select("_g", "n", F.explode(F.array(*rows)).alias("_q"))
    return out.select(*[F.col("_g")[c].alias(c) for c in gcols], F.col("_q.prob").alias("prob"),
                      F.col("_q.quantile").alias("quantile"), "n")


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float] = (0.5,)) -> DataFrame:
    """(column, prob, quantile, n) of several columns at once (unpivoted to long form)."""
    long = df.select([F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "column", "value")
    return exact_quantiles(long, "value", probs, ["column"])


def column_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact median of each column (one row per column reaches the driver)."""
    cols = list(columns)
    if not cols:
        return {}
    found = {r["column"]: r["quantile"] for r in column_quantiles(df, cols).collect()}
    return {c: found.get(c) for c in cols}


def cutoff_keys(df: DataFrame, hash_col: str, quota, group_col: str | None = None) -> DataFrame:
    """For each group the k-th smallest ``hash_col`` (hexadecimal text, uniform), k = ``quota(rows of the group)``.

    Output: ``_grp`` (struct of the group column), ``cutoff``, ``k``, ``reached`` (rows up to the
    cutoff; more than k if rows share the cutoff's hash).  Groups with k = 0 are absent.
    """
    key = _group_key([group_col] if group_col else []).alias("_g")
    base = df.select(key, F.col(hash_col).alias("_h"), F.substring(hash_col, 1, 4).alias("_p"))
    cells = base.groupBy("_g", "_p").agg(F.count(F.lit(1)).alias("_c"))  # at most 65,536 a group
    cells = settled(cells, "split-cells")
    k = cells.groupBy("_g").agg(quota(F.sum("_c")).cast("long").alias("k")).filter("k > 0")
    upto = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)
    place = cells.withColumn("_upto", F.sum("_c").over(upto)).join(k, "_g")
    place = place.filter((F.col("_upto") >= F.col("k")) & (F.col("_upto") - F.col("_c") < F.col("k")))
    place = settled(place.select("_g", "_p", "k", (F.col("_upto") - F.col("_c")).alias("_below")), "split-place")
    near = base.join(place.select("_g", "_p"), ["_g", "_p"], "left_semi")  # one 65,536th of the rows
    same = near.groupBy("_g", "_h").agg(F.count(F.lit(1)).alias("_c"))
    cum = ordered_prefix_sums(same, "_h", ["_c"], ["_g"], prefix="_upto").join(place.drop("_p"), "_g")
    hit = cum.filter((F.col("_below") + F.col("_upto_c") >= F.col("k"))
                     & (F.col("_below") + F.col("_upto_c") - F.col("_c") < F.col("k")))
    return hit.select(F.col("_g").alias(_KEY), F.col("_h").alias("cutoff"), "k",
                      (F.col("_below") + F.col("_upto_c")).alias("reached"))
