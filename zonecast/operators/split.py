"""Deterministic stratified train/test split.

Each row gets ``md5(seed | key columns)``; within each class the ``round(t*n)``
rows with the smallest hash form the test set.  The cut-off hash per class comes
from ``selection.cutoff_keys``, so no class is ranked inside one task.  The split
is a pure function of the key, so it is identical under repartitioning and
re-execution after executor loss.

Key columns must identify rows.  Where repeated keys would move the split off
its quota, it raises and names the class and both counts.  A null in a key
column is a value of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast import schema as S
from zonecast.operators.selection import cutoff_keys
from zonecast.session import settled

NULL_KEY = "\u0000"


def split_hash(key_cols: Sequence[str], seed: int | None = S.RANDOM_STATE) -> Column:
    seed = S.RANDOM_STATE if seed is None else seed  # None means default; 0 stays 0
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_KEY)) for c in key_cols]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def test_quota(n, test_size: float):
    return F.floor(F.lit(float(test_size)) * n + 0.5)


def stratified_split(df: DataFrame, key_cols: Sequence[str], label_col: str = "is_strike",
                     test_size: float = 0.2, seed: int | None = S.RANDOM_STATE, stratify: bool = True,
                     split_col: str = "split") -> DataFrame:
    """Add ``split`` ('train'/'test').  ``key_cols`` must identify rows uniquely."""
    hashed = df.withColumn("_h", split_hash(key_cols, seed))
    group = label_col if stratify else None
    cut = settled(cutoff_keys(hashed, "_h", lambda n: test_quota(n, test_size), group), "split-cutoffs")
    off = cut.filter("reached <> k").limit(5).collect()
    if off:
        raise ValueError(f"split keys {list(key_cols)} are not unique: " + ", ".join(
            f"{tuple(r['_grp'])} would get {r['reached']} test rows instead of {r['k']}" for r in off))
    # one row a class: its file's size decides whether Spark broadcasts it
    own = hashed.withColumn("_grp", F.struct(F.col(group)) if group else F.struct(F.lit(0).alias("_c")))
    both = own.join(cut.select("_grp", "cutoff"), "_grp", "left")
    return both.select(*df.columns, F.when(F.col("_h") <= F.col("cutoff"), "test").otherwise("train").alias(split_col))
