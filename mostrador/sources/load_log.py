"""The load status: an append-only log whose latest entry counts.

An entry is one small committed write, so a reader sees a load either as
finished, with the folder that holds it, or not at all.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SCHEMA = (
    "completed boolean, completed_at timestamp, logged_at timestamp, "
    "rows bigint, skipped bigint, rejected bigint, folder string"
)


class LoadState(NamedTuple):
    completed: bool
    rows: int | None
    folder: str | None
    skipped: int | None = None  # lines with too many fields
    rejected: int | None = None  # lines with values that do not fit their columns


def _log(root: str) -> str:
    return f"{root.rstrip('/')}/estado_carga"


def _append(spark: SparkSession, root: str, state: LoadState) -> None:
    now = F.current_timestamp()
    entry = spark.range(1).select(
        F.lit(state.completed).alias("completed"),
        (now if state.completed else F.lit(None).cast("timestamp")).alias("completed_at"),
        now.alias("logged_at"),
        *[F.lit(getattr(state, c)).cast("bigint").alias(c) for c in ("rows", "skipped", "rejected")],
        F.lit(state.folder).cast("string").alias("folder"),
    )
    entry.coalesce(1).write.mode("append").parquet(_log(root))


def mark_complete(
    spark: SparkSession, root: str, rows: int, folder: str, skipped: int | None = None, rejected: int | None = None
) -> None:
    """Publish a finished load. To be called after its data is fully written."""
    _append(spark, root, LoadState(True, rows, folder, skipped, rejected))


def reset(spark: SparkSession, root: str) -> None:
    """Mark the load as not done, so the next one starts over. For manual use and tests."""
    _append(spark, root, LoadState(False, None, None))


def load_log(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(_SCHEMA).parquet(_log(root))
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def load_state(spark: SparkSession, root: str) -> LoadState:
    log = load_log(spark, root)
    latest = None
    if log is not None:
        latest = log.agg(F.max_by(F.struct(*LoadState._fields), "logged_at")).first()[0]
    return LoadState(*latest) if latest else LoadState(False, None, None)


def published_folders(spark: SparkSession, root: str) -> set[str]:
    """The folders of all loads that were ever finished: one short text per load."""
    log = load_log(spark, root)
    return set() if log is None else {r["folder"] for r in log.where("completed").select("folder").collect()}


def is_complete(spark: SparkSession, root: str) -> bool:
    return load_state(spark, root).completed
