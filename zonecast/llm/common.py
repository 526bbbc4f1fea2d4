"""Small helpers shared by the text operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settled, shared_path

__all__ = ["crc_bucket", "fresh_folder", "settled", "table", "text_or_empty"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark so that any store it knows will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return shared_path(spark, f"{name}-{uuid.uuid4().hex}")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def crc_bucket(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(mod)
