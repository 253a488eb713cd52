"""Writing report tables as JSON."""

from __future__ import annotations

import logging

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame

_log = logging.getLogger(__name__)


def save_report(report: DataFrame, folder: str, name: str) -> bool:
    """Write ``<folder>/<name>.json``. A failure is logged, not raised: data comes first."""
    target = f"{folder.rstrip('/')}/{name.removesuffix('.json')}.json"
    try:
        # A report has a fixed number of rows: one per metric and column.
        report.coalesce(1).write.mode("overwrite").json(target)
    except PySparkException as exc:
        _log.warning("report %s was not written: %s", target, exc)
        return False
    return True
