"""Attach a per-key value to every row, whatever the key distribution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 16 << 20  # sent to every executor at most
_PER_KEY = 64  # bytes of a key's entry beside the key


def lookup_by_key(
    rows: DataFrame, table: DataFrame, key: str, value: str, weight: str, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Left lookup of ``table.value`` by ``key``; no row is added or lost.

    ``table`` holds one row per key and the number of rows it has in ``weight``.
    It is read several times, so it should be a stored or checkpointed one.

    Its longest key says how many keys ``broadcast_bytes`` hold in any case. Up to that many keys, the
    table is broadcast. Beyond that, only its hot keys are: those with more than their share
    of all rows, of which there can never be more than that many. The rows of hot keys and the rows
    without a key take no part in the shuffle: they stay in the tasks that read them, so however
    alike they are, no task gathers them, and a task that is run again sends nothing elsewhere. All
    others are shuffled. ``rows`` is read twice then.
    """
    measured = table.agg(
        F.count(F.lit(1)).alias("keys"),
        F.max(F.octet_length(F.col(key).cast("string"))).alias("longest"),
        F.sum(weight).alias("rows"),
    ).first()
    fitting = broadcast_bytes // ((measured["longest"] or 0) + _PER_KEY)
    values = table.select(key, value)
    if measured["keys"] <= fitting:
        return rows.join(F.broadcast(values), key, "left")

    hot = table.where(F.col(weight) > measured["rows"] / max(fitting, 1))
    here = rows.join(F.broadcast(hot.select(key, value, F.lit(True).alias("_hot"))), key, "left")
    settled = here.where(F.col("_hot").isNotNull() | F.col(key).isNull()).drop("_hot")
    others = rows.where(F.col(key).isNotNull()).join(F.broadcast(hot.select(key)), key, "left_anti")
    return settled.unionByName(others.join(values, key, "left"))
