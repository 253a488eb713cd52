"""The stored fact table: Parquet folders by month, and the months found in data."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mostrador import schema as S
from mostrador.functions import derive
from mostrador.operators.filters import CUSTOMER_KEY, MONTH_COLUMN
from mostrador.session import PACKED, release_shuffles

_STORED = T.StructType(
    [
        *S.FACT_SCHEMA.fields,
        T.StructField(CUSTOMER_KEY, T.StringType()),
        T.StructField(MONTH_COLUMN, T.StringType()),
    ]
)
LAYOUT_COLUMNS = (CUSTOMER_KEY, MONTH_COLUMN)


def to_fact_columns(df: DataFrame) -> DataFrame:
    """The stored columns that are present, in table order, lower-cased, in table types."""
    present = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            F.col(present[f.name]).cast(f.dataType).alias(f.name)
            for f in S.FACT_SCHEMA.fields
            if f.name in present
        ]
    )


def month_partitions(df: DataFrame, column: str = S.SALE_TIME) -> DataFrame:
    """(nombre, inicio, fin) of every month present; missing times belong to no month."""
    at = F.col(column)
    return (
        df.where(at.isNotNull())
        .select(
            derive.month_name(at).alias("nombre"),
            derive.month_start(at).alias("inicio"),
            derive.month_end(at).alias("fin"),
        )
        .distinct()
    )


def months_present(df: DataFrame, column: str = S.SALE_TIME) -> DataFrame:
    """The distinct month labels in the data."""
    at = F.col(column)
    return df.where(at.isNotNull()).select(derive.month_label(at).alias(MONTH_COLUMN)).distinct()


def write_facts(df: DataFrame, folder: str, turns: int = 1) -> int:
    """Write to an unused folder and return the number of rows, counted while writing.

    Rebalancing by month gives each month few files of even size: a month that
    holds a third of all sales is split over many tasks, small ones are merged.
    Sorting by customer inside a task keeps the range of customers per row group
    narrow, so that looking one up skips nearly all of them.

    In several ``turns``, each takes the whole months that a hash deals to it, and its shuffles are
    let go before the next one, so only a part of the rows is in shuffle files at any time. ``df`` is read once a turn.
    """
    dated = df.withColumn(MONTH_COLUMN, derive.month_label(F.col("fecha")))
    rows = 0
    for turn in range(turns):
        release_shuffles(df.sparkSession)
        part = dated if turns == 1 else dated.where(F.pmod(F.xxhash64(MONTH_COLUMN), F.lit(turns)) == turn)
        seen = Observation(f"facts-{uuid.uuid4().hex}")
        # The key repeats a column, so it is added after the shuffle.
        keyed = part.hint("rebalance", F.col(MONTH_COLUMN)).withColumn(CUSTOMER_KEY, F.lower("codigo_cliente"))
        laid_out = keyed.select(*df.columns, *LAYOUT_COLUMNS).sortWithinPartitions(*reversed(LAYOUT_COLUMNS))
        (
            laid_out.observe(seen, F.count(F.lit(1)).alias("rows"))
            .write.mode("append" if turn else "errorifexists")
            .options(**PACKED)
            .partitionBy(MONTH_COLUMN)
            .parquet(folder)
        )
        rows += seen.get["rows"]
    return rows


def read_facts(spark: SparkSession, folder: str) -> DataFrame:
    """The fact table; filters on the month column skip folders, others reach the Parquet scan."""
    return spark.read.schema(_STORED).parquet(folder)
