"""Entry 1 as a file stream: new raw pitch files are labelled, cleaned and
appended to the processed table exactly once.

Labelling and cleaning are stateless row filters, so the streaming plan is
the batch plan.  Source and sink progress live beside the output
(``<output>_progress`` unless another folder is given), never in a folder of the
session, so a restarted or re-executed query resumes without loss or duplicates.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from zonecast import schema as S
from zonecast.plans.dataset import build_processed
from zonecast.sources.pitch_io import CSV_SCHEMA, _normalise_nan, typed


def start_incremental_prep(spark: SparkSession, raw_dir: str, output_dir: str, checkpoint: str | None = None,
                           fmt: str = "parquet", schema=None, available_now: bool = True,
                           max_files_per_trigger: int | None = None) -> StreamingQuery:
    kinds = schema or S.RAW_PITCH_SCHEMA
    reader = spark.readStream.format(fmt)
    if fmt == "csv":  # read as text, then typed like a batch file
        reader = reader.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in kinds.fields])).option("header", True)
    else:
        reader = reader.schema(kinds)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    loaded = reader.load(raw_dir)
    raw = _normalise_nan(typed(loaded, schema or CSV_SCHEMA) if fmt == "csv" else loaded)
    S.require_columns(raw, S.REQUIRED_COLUMNS, "raw stream")
    writer = (build_processed(raw).writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint or output_dir.rstrip("/") + "_progress")
              .option("path", output_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
