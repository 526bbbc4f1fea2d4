"""SparkSession helpers.

The checkpoint directory is read from the session (``spark.checkpoint.dir``,
which a cluster points at shared storage); a local default is set only when it
is unset, e.g. in tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "zonecast") -> SparkSession:
    b = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        b = b.master(master)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint directory (``spark.checkpoint.dir``).

    On a local master, where driver and executors are one machine, a scratch
    folder is set if it is unset; on a cluster that would lose data, so it raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="zonecast-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name


def settled(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back.

    Later steps neither repeat its work nor lose it with an executor, and its
    file size tells the planner whether it may be broadcast.
    """
    path = shared_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    made_tables(df.sparkSession).append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def made_tables(spark: SparkSession) -> list[str]:
    """The intermediate tables written by this application so far, in order."""
    sc = spark.sparkContext
    if not hasattr(sc, "_zonecast_made"):
        sc._zonecast_made = []
    return sc._zonecast_made


def drop_tables(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Delete intermediate tables from place ``since`` on, but for the last ``keep``; results that read them must be written."""
    made = made_tables(spark)
    gone = made[since : len(made) - keep]
    for path in gone:
        drop_path(spark, path)
    made[since : len(made) - keep] = []


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a table or folder through Hadoop's file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per SparkContext (what ``--py-files`` does)."""
    sc = spark.sparkContext
    if getattr(sc, "_zonecast_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="zonecast-py-"), "zonecast_py.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("zonecast", os.path.relpath(full, root)))
    sc.addPyFile(target)
    sc._zonecast_shipped = True
