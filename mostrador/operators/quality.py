"""Data-quality profiles: every one is a single scan with small partial results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mostrador.errors import MissingColumnsError
from mostrador.functions.casting import blank_to_null, to_decimal


def _per_column(df: DataFrame, measures: dict[str, Column], value_name: str) -> DataFrame:
    """One aggregate over the data, turned into (column, value) rows."""
    if not measures:
        return df.sparkSession.createDataFrame([], f"column string, {value_name} bigint")
    names = list(measures)
    totals = df.agg(*[measures[name].alias(f"m{i}") for i, name in enumerate(names)])
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("column"), F.col(f"m{i}").alias(value_name))
            for i, name in enumerate(names)
        ]
    )
    return totals.select(F.inline(rows))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, nulls) of the columns that have any."""
    counts = {c: F.count_if(F.col(c).isNull()) for c in (columns or df.columns)}
    return _per_column(df, counts, "nulls").where("nulls > 0")


def infinite_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, infinite) for the listed columns that exist; NULL counts as finite."""
    present = [c for c in columns if c in df.columns]
    counts = {c: F.count_if(F.abs(F.col(c).cast("double")) == F.lit(float("inf"))) for c in present}
    return _per_column(df, counts, "infinite")


def type_conformance(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, non_numeric): texts that are not missing and not a number."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise MissingColumnsError(f"columns not present: {sorted(absent)}")
    counts = {}
    for c in columns:
        text = blank_to_null(F.col(c).cast("string"))
        counts[c] = F.count_if(text.isNotNull() & to_decimal(text).isNull())
    return _per_column(df, counts, "non_numeric")


def require_numeric(df: DataFrame, column: str) -> None:
    """Raise unless the column exists and has a numeric type."""
    types = dict(df.dtypes)
    if column not in types:
        raise MissingColumnsError(f"column '{column}' does not exist")
    if not types[column].startswith(("bigint", "int", "smallint", "tinyint", "double", "float", "decimal")):
        raise MissingColumnsError(f"column '{column}' should be numeric but is {types[column]}")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def channel_domain(df: DataFrame, column: str = "CANAL") -> DataFrame:
    """The distinct channels in alphabetical order; a missing channel is no channel."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)
