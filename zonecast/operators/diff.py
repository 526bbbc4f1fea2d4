"""Differences between two versions of a table, and rebuilding only the partitions that differ.

Rows are bags: a row that stands three times in one version and once in the other differs twice.
Both versions are united with a sign and summed, so there is no join, equal rows are combined before the
shuffle, and one repeated row is no hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.session import drop_path


def _same_columns(old: DataFrame, new: DataFrame) -> None:
    if sorted(old.columns) != sorted(new.columns):
        raise ValueError(f"the versions have different columns: {sorted(set(old.columns) ^ set(new.columns))}")


def row_hash(columns: Sequence[str]) -> Column:
    """128 bits of a row: null and a value in the next column are told apart by a flag per column."""
    flags = F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in columns])
    return F.struct(F.xxhash64(flags, *columns).alias("a"), F.xxhash64(F.lit(1), *columns, flags).alias("b"))


def row_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """The columns, ``change`` (``added`` or ``removed``), ``n_rows``: what ``EXCEPT ALL`` gives in both directions, counted."""
    _same_columns(old, new)
    cols = old.columns
    both = old.select(*cols, F.lit(-1).alias("_sign")).unionByName(new.select(*cols, F.lit(1).alias("_sign")))
    out = both.groupBy(*cols).agg(F.sum("_sign").alias("_n")).where("_n <> 0")
    return out.select(*cols, F.when(F.col("_n") > 0, "added").otherwise("removed").alias("change"), F.abs("_n").alias("n_rows"))


def keyed_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, ``change`` (``added``, ``removed`` or ``changed``), n_old, n_new: keys whose rows differ.

    Null keys are compared like any other; a key may have several rows, which are compared as a bag.
    """
    _same_columns(old, new)
    side = lambda df, a, b: df.select(*keys, row_hash(old.columns).alias("_row"), F.lit(a).alias("_old"), F.lit(b).alias("_new"))
    rows = side(old, 1, 0).unionByName(side(new, 0, 1)).groupBy(*keys, "_row").agg(F.sum("_old").alias("_old"), F.sum("_new").alias("_new"))
    by_key = rows.groupBy(*keys).agg(F.sum("_old").alias("n_old"), F.sum("_new").alias("n_new"), F.max(F.col("_old") != F.col("_new")).alias("_differs")).where("_differs")
    change = F.when(F.col("n_old") == 0, "added").when(F.col("n_new") == 0, "removed").otherwise("changed")
    return by_key.select(*keys, change.alias("change"), "n_old", "n_new")


def partition_diff(old: DataFrame, new: DataFrame, by: Sequence[str]) -> DataFrame:
    """by, ``change``: partitions whose bags of rows differ, by their sizes and sums of row hashes."""
    _same_columns(old, new)
    side = lambda df, v: df.select(*by, row_hash(old.columns).alias("_h"), F.lit(v).alias("_v"))
    total = lambda v, c: F.sum(F.when(F.col("_v") == v, F.col(f"_h.{c}").cast("decimal(20,0)")))
    n = lambda v: F.count_if(F.col("_v") == v)
    sums = side(old, 0).unionByName(side(new, 1)).groupBy(*by).agg(n(0).alias("n_old"), n(1).alias("n_new"), *[total(v, c).alias(f"_{c}{v}") for v in (0, 1) for c in "ab"])
    differs = (F.col("n_old") != F.col("n_new")) | (F.col("_a0") != F.col("_a1")) | (F.col("_b0") != F.col("_b1"))
    change = F.when(F.col("n_old") == 0, "added").when(F.col("n_new") == 0, "removed").otherwise("changed")
    return sums.where(differs).select(*by, change.alias("change"), "n_old", "n_new")


def rebuild_partitions(new: DataFrame, path: str, by: Sequence[str]) -> DataFrame:
    """Bring the parquet table at ``path`` (partitioned by ``by``) to ``new`` by writing only the partitions that differ.

    Gives the partitions and what became of them (read before writing, so it says what was done).  A table that isn't there
    is written whole.  ``new`` must not read the table itself.
    """
    from zonecast.session import settled

    spark = new.sparkSession
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
    old = spark.read.schema(new.schema).parquet(path).select(*new.columns) if there else new.limit(0)
    todo = settled(partition_diff(old, new, by), "partition-diff")
    same = [new[c].eqNullSafe(todo[c]) for c in by]
    rows = new.join(todo.where("change <> 'removed'"), [s for s in same], "left_semi")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    for r in todo.where("change = 'removed'").select(*[F.col(c).cast("string") for c in by]).collect():  # as many as folders to delete
        esc = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        drop_path(spark, path.rstrip("/") + "/" + "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if r[c] is None else esc.escapePathName(r[c])}" for c in by))
    return todo
