"""Readers and writers for pitch tables, metrics and models.

Reads take an explicit schema (no inference pass over the data), normalise NaN
to null, and check the required columns before any job runs.  Writes are
parquet by default so later scans get column pruning and predicate pushdown.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast import schema as S
from zonecast.sources.scan import spread


def _normalise_nan(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not floats:
        return df
    return df.withColumns({c: F.when(F.isnan(c), F.lit(None)).otherwise(F.col(c)) for c in floats})


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


# fixed values: text that stands for a missing value in the original's CSV files
MISSING_TEXT = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
                "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
CSV_SCHEMA = T.StructType([*S.RAW_PITCH_SCHEMA.fields, T.StructField("is_strike", T.IntegerType(), True)])


def typed(df: DataFrame, schema: T.StructType = CSV_SCHEMA, malformed: str = "fail") -> DataFrame:
    """Text columns as read from CSV, in the types of ``schema`` (other columns stay text).

    Missing tokens are null.  Whole numbers may be written as ``1`` or ``1.0``.  Other
    text in a numeric column (or a fraction in a whole-number column) fails the query and
    names column and value; ``malformed='null'`` makes it null instead.
    """
    if malformed not in ("fail", "null"):
        raise ValueError("malformed must be 'fail' or 'null'")
    kinds = {f.name: f.dataType for f in schema.fields}
    out = []
    for c in df.columns:
        raw = F.trim(F.col(c))
        text = F.when(~raw.isin(*MISSING_TEXT), F.col(c))
        kind = kinds.get(c, T.StringType())
        if isinstance(kind, T.StringType):
            out.append(text.alias(c))
            continue
        if isinstance(kind, T.NumericType):
            number = text.try_cast("double")
            whole = isinstance(kind, T.IntegralType)
            value = F.when(number == F.floor(number), number.cast(kind)) if whole else F.when(~F.isnan(number), number.cast(kind))
        else:
            value = text.try_cast(kind)
        if malformed == "fail":
            value = F.when(text.isNotNull() & value.isNull(), F.raise_error(
                F.concat(F.lit(f"malformed {c}: "), text)).cast(kind)).otherwise(value)
        out.append(value.alias(c))
    return df.select(*out)


def load_pitches(spark: SparkSession, path: str, fmt: str | None = None,
                 schema: T.StructType | None = None, required: Sequence[str] = S.REQUIRED_COLUMNS,
                 malformed: str = "fail", where: Column | None = None) -> DataFrame:
    """Read a raw or processed pitch table (CSV with header, or parquet).

    Missing path -> FileNotFoundError; missing required columns -> ValueError
    listing missing and available columns.  CSV values are typed by ``typed``.
    ``where`` is applied to the rows as stored, below the rewrite of NaN, so that a
    parquet scan can push it down.
    """
    if not _exists(spark, path):
        raise FileNotFoundError(f"no pitch table at {path}")
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    if fmt == "csv":
        text = spark.read.option("header", True).csv(path)  # every column as text
        df = typed(text, schema or CSV_SCHEMA, malformed)
    else:
        df = spark.read.parquet(path)
    S.require_columns(df, required, "pitch table")
    if where is not None:
        df = df.filter(where)
    return _normalise_nan(spread(df))


def save_raw(df: DataFrame, path: str, overwrite: bool = False, partition_by: Sequence[str] = ()) -> bool:
    """Write the raw table; when it exists and ``overwrite`` is False, skip.  Returns True if written."""
    spark = df.sparkSession
    if not overwrite and _exists(spark, path):
        return False
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return True


def save_processed(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Always replace.  Partition by a date or season column to enable pruning."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def save_metrics(metrics: DataFrame, base_path: str) -> None:
    """Write ``<base>.csv`` and ``<base>.json`` directories; NaN becomes null."""
    rows = _normalise_nan(metrics).collect()  # one row per model: evaluated once, written twice
    clean = metrics.sparkSession.createDataFrame(rows, metrics.schema).coalesce(1)
    clean.write.mode("overwrite").option("header", True).csv(base_path + ".csv")
    clean.write.mode("overwrite").json(base_path + ".json")


def read_metrics(spark: SparkSession, base_path: str) -> DataFrame:
    return spark.read.schema(S.METRICS_SCHEMA).json(base_path + ".json")


def get_model_metrics(spark: SparkSession, base_path: str, model_name: str) -> dict | None:
    """Metrics row of one model as a dict, or None when the file or model is absent."""
    if not _exists(spark, base_path + ".json"):
        return None
    row = read_metrics(spark, base_path).filter(F.col("model") == model_name).first()
    return None if row is None else {k: row[k] for k in row.asDict() if k != "model"}


def save_model(model: PipelineModel, models_dir: str, name: str) -> str:
    path = models_dir.rstrip("/") + "/" + name
    model.write().overwrite().save(path)
    return path


def list_models(spark: SparkSession, models_dir: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(models_dir)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory() and not s.getPath().getName().startswith("_")]
    return sorted(n for n in names if fs.exists(jvm.org.apache.hadoop.fs.Path(models_dir.rstrip("/") + "/" + n + "/metadata")))


def load_model(spark: SparkSession, models_dir: str, name: str) -> PipelineModel:
    available = list_models(spark, models_dir)
    if name not in available:
        raise FileNotFoundError(f"no model {name} in {models_dir}; saved there: {available}")
    return PipelineModel.load(models_dir.rstrip("/") + "/" + name)


def load_all_models(spark: SparkSession, models_dir: str) -> dict[str, PipelineModel]:
    """Every saved model in the directory, in sorted name order."""
    return {n: PipelineModel.load(models_dir.rstrip("/") + "/" + n) for n in list_models(spark, models_dir)}


__all__ = ["load_pitches", "save_raw", "save_processed", "save_metrics", "read_metrics", "get_model_metrics",
           "save_model", "list_models", "load_model", "load_all_models", "typed"]
