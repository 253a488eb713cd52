"""Session settings and the shared working folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# For stored steps that hold all rows: about two thirds of the disk that the default packing takes.
PACKED = {"compression": "zstd"}

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot partition even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.files.maxPartitionBytes": "64m",
}


def build_session(app_name: str = "mostrador", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings this library is tuned for; ``extra`` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name that every executor can reach.

    The cluster names the shared root in ``spark.checkpoint.dir``. Only a local
    session, where driver and executors are one machine, may fall back to a
    temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="mostrador-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> bool:
    """Delete a folder through the file system it is in; False if it was not there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def subfolders(spark: SparkSession, folder: str) -> list[str]:
    """The names of what lies directly in a folder; none if it does not exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []


def release_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished work: Spark deletes them when the driver's garbage is collected."""
    gc.collect()
    spark._jvm.System.gc()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute once and keep in the checkpoint folder, so a lost executor costs a re-read.

    The session's own checkpoint folder is used; one is set only where there is none.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession, "checkpoint"))
    return df.checkpoint()
