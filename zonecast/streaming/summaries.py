"""Rates per time window of a stream whose rows may come twice, late or out of order.

The watermark bounds the state: a row's key is remembered until its time is behind the watermark, a window is emitted once,
when the watermark passes its end, and rows behind the watermark are dropped and counted.  Progress and state live beside the
output, so a restarted query goes on where it stopped and never emits a window twice.  Over rows that come no later
than ``lateness`` the result is the batch result (``windowed_rates`` on the whole table).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def windowed_rates(df: DataFrame, time_col: str, window: str, by: Sequence[str], label_col: str, slide: str | None = None) -> DataFrame:
    """by, window_start, window_end, n_rows, n_strikes: rows and labels per window (batch or stream).  Rows without time count nowhere."""
    w = F.window(time_col, window, slide) if slide else F.window(time_col, window)
    rates = df.groupBy(w.alias("_w"), *by).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(label_col).cast("long").alias("n_strikes"))
    return rates.select(*by, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "n_rows", "n_strikes")


def start_windowed_rates(spark: SparkSession, source: str, output: str, schema: T.StructType, *, key_cols: Sequence[str], time_col: str, by: Sequence[str], label_col: str,
                         window: str = "1 hour", lateness: str = "2 hours", slide: str | None = None, checkpoint: str | None = None, max_files_per_trigger: int = 1,
                         available_now: bool = True, prepare: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Read parquet files as they come, count each key once, and append finished windows to ``output``.

    ``prepare`` makes the columns from those of the files (projections and filters).

    Equal keys must have equal times (a repeated delivery).  Windows that the watermark has not passed stay in the state
    when the input ends, as more rows may follow.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(source)
    rows = prepare(rows) if prepare else rows
    once = rows.withWatermark(time_col, lateness).dropDuplicates([*key_cols, time_col])
    writer = (windowed_rates(once, time_col, window, by, label_col, slide).writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint or output.rstrip("/") + "_progress").option("path", output))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def late_rows(query: StreamingQuery) -> int:
    """Rows of this run that the first stateful step dropped as too late (repeats of keys are not among them)."""
    steps = [p.stateOperators for p in query.recentProgress]
    return sum(s[-1].numRowsDroppedByWatermark for s in steps if s)
