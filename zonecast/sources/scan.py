"""Scan helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Repartition a scan that yields fewer partitions than the cluster can run.

    Large inputs (many files / row groups) already split into thousands of
    partitions and pass through untouched; a small single-row-group file would
    otherwise put every downstream narrow operator into one task.
    """
    sc = df.sparkSession.sparkContext
    target = min_partitions or sc.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df
