"""Entry 1: raw pitches -> label -> clean -> processed table (one lazy plan, one write)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from zonecast.operators.prep import basic_cleaning, label_outcomes, speed_condition
from zonecast.sources.pitch_io import load_pitches, save_processed


def build_processed(raw: DataFrame) -> DataFrame:
    """Label then clean; narrow only, so it streams through with no shuffle."""
    return basic_cleaning(label_outcomes(raw))


def prepare_dataset(spark: SparkSession, raw_path: str, output_path: str,
                    partition_by: Sequence[str] = ()) -> DataFrame:
    # the speed bounds drop NaN themselves, so they may run below its rewrite and reach the scan
    raw = load_pitches(spark, raw_path, where=speed_condition())
    save_processed(build_processed(raw), output_path, partition_by)
    return spark.read.parquet(output_path)
