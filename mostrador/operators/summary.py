"""The seven-statistic summary of the measure under any combination of filters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mostrador.operators.filters import Filter, apply_filters
from mostrador.operators.histogram import melt
from mostrador.operators.quantiles import group_summary
from mostrador.schema import MEASURE


def statistics(n: Column, total: Column, low: Column, high: Column, median: Column, sd: Column) -> list[Column]:
    """The seven result fields; all zero when no row qualifies."""
    zero = F.lit(0.0)
    return [
        F.coalesce(total, zero).alias("suma"),
        F.coalesce(n, F.lit(0)).cast("bigint").alias("conteo"),
        F.coalesce(total / F.nullif(n, F.lit(0)), zero).alias("promedio"),
        F.coalesce(low, zero).alias("minimo"),
        F.coalesce(high, zero).alias("maximo"),
        F.coalesce(median, zero).alias("mediana"),
        F.coalesce(sd, zero).alias("desviacion_estandar"),
    ]


def summary(df: DataFrame, filters: Iterable[Filter] = (), measure: str = MEASURE) -> DataFrame:
    """One row with the seven statistics of ``measure`` over the rows the filters keep."""
    kept = apply_filters(df, filters)
    found = group_summary(melt(kept, [measure]), ["column"], few_groups=True)
    fields = ("n", "total", "low", "high", "median", "deviation")
    # A global aggregate yields its row even when nothing was found.
    one = found.agg(*[F.max(c).alias(c) for c in fields])
    return one.select(*statistics(*[F.col(c) for c in fields]))
