"""Median imputation and outlier marking, as fit (one row of parameters) and apply.

Parameters travel as a one-row DataFrame and reach the rows through a scalar
subquery, so fit and apply stay one lazy plan. Rows are never dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mostrador.operators.quantiles import column_quantiles
from mostrador.schema import (
    FENCE_FACTOR,
    MEDIAN_IMPUTED,
    NEVER_IMPUTED,
    OUTLIER_COLUMNS,
    OUTLIER_SUFFIX,
    TREATMENT_FLAGGED,
    TREATMENT_MEDIAN,
    TREATMENT_NONE,
    ZSCORE_THRESHOLD,
)

_QUARTILES = {"q1": 0.25, "q2": 0.5, "q3": 0.75}


def single_row(params: DataFrame) -> Column:
    """A one-row DataFrame as a struct column usable inside another DataFrame."""
    return params.select(F.struct("*").alias("params")).scalar()


def settle(params: DataFrame) -> DataFrame:
    """Run a fit once and keep its single row, so that later steps do not fit again."""
    return params.sparkSession.createDataFrame([params.first()], params.schema)


def _present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def fences(df: DataFrame, columns: Sequence[str] = OUTLIER_COLUMNS, k: float = FENCE_FACTOR) -> DataFrame:
    """(column, q1, q3, low, high): the interquartile fences of each column."""
    spread = F.col("q3") - F.col("q1")
    return column_quantiles(df, _present(df, columns), {"q1": 0.25, "q3": 0.75}).select(
        "column",
        "q1",
        "q3",
        (F.col("q1") - k * spread).alias("low"),
        (F.col("q3") + k * spread).alias("high"),
    )


def count_measures(df: DataFrame) -> list[Column]:
    """The aggregates behind the counts of a fit: rows, and nulls per column."""
    return [F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in df.columns]]


def fit_cleaning(df: DataFrame, k: float = FENCE_FACTOR) -> DataFrame:
    """One row: row count, nulls per column, medians to impute, outlier fences.

    Two scans: one for the counts, one shared by all quantiles.
    """
    counts = df.agg(*count_measures(df))
    bounds = _bounds(df, k)
    if bounds is None:
        return counts
    return counts.withColumn("q", single_row(bounds)).select(*counts.columns, "q.*")


def settled_fit(df: DataFrame, k: float = FENCE_FACTOR) -> DataFrame:
    """``fit_cleaning``, run once: its row as data of its own, so that later steps do not fit again."""
    counts = settle(df.agg(*count_measures(df)))
    bounds = settled_bounds(df, k)
    if bounds is None:
        return counts
    schema = T.StructType([*counts.schema.fields, *bounds.schema.fields])
    return df.sparkSession.createDataFrame([(*counts.first(), *bounds.first())], schema)


def settled_bounds(df: DataFrame, k: float = FENCE_FACTOR) -> DataFrame | None:
    """What ``apply_cleaning`` needs of a fit, run once: medians and fences, no counts. None where nothing is fitted."""
    bounds = _bounds(df, k)
    return None if bounds is None else settle(bounds)


def _bounds(df: DataFrame, k: float) -> DataFrame | None:
    """One row: the medians to impute and the outlier fences of the columns that are there."""
    imputed = _present(df, MEDIAN_IMPUTED)
    flagged = _present(df, OUTLIER_COLUMNS)
    if not imputed + flagged:
        return None
    table = column_quantiles(df, imputed + flagged, _QUARTILES)

    def of(column: str, value: Column) -> Column:
        return F.max(F.when(F.col("column") == column, value))

    spread = F.col("q3") - F.col("q1")
    bounds = [of(c, F.col("q2")).alias(f"median_{c}") for c in imputed]
    for c in flagged:
        bounds.append(of(c, F.col("q1") - k * spread).alias(f"low_{c}"))
        bounds.append(of(c, F.col("q3") + k * spread).alias(f"high_{c}"))
    return table.agg(*bounds)


def outside(value: Column, low: Column, high: Column) -> Column:
    """Strictly outside the fences; a missing value or fence is no outlier."""
    x = value.cast("double")
    return F.coalesce((x < low) | (x > high), F.lit(False))


def apply_cleaning(df: DataFrame, params: DataFrame) -> DataFrame:
    """Impute and mark with given parameters; nothing is computed from ``df`` itself."""
    p = single_row(params)
    new: dict[str, Column] = {}
    for c in _present(df, MEDIAN_IMPUTED):
        if f"median_{c}" in params.columns:
            new[c] = F.coalesce(F.col(c), p[f"median_{c}"])
    for c in _present(df, OUTLIER_COLUMNS):
        if f"low_{c}" in params.columns:
            new[c + OUTLIER_SUFFIX] = outside(F.col(c), p[f"low_{c}"], p[f"high_{c}"])
    return df.withColumns(new) if new else df


def impute_median(df: DataFrame, columns: Sequence[str] = MEDIAN_IMPUTED) -> DataFrame:
    """Fill missing numbers with the exact median of the column; absent columns are skipped."""
    columns = _present(df, columns)
    if not columns:
        return df
    table = column_quantiles(df, columns, {"median": 0.5})
    medians = table.agg(
        *[F.max(F.when(F.col("column") == c, F.col("median"))).alias(c) for c in columns]
    )
    p = single_row(medians)
    return df.withColumns({c: F.coalesce(F.col(c), p[c]) for c in columns})


def outliers_iqr(df: DataFrame, column: str, k: float = FENCE_FACTOR) -> DataFrame:
    """Add ``<column>_ES_OUTLIER`` by the interquartile rule."""
    p = single_row(fences(df, [column], k).agg(F.max("low").alias("low"), F.max("high").alias("high")))
    return df.withColumn(column + OUTLIER_SUFFIX, outside(F.col(column), p["low"], p["high"]))


def outliers_zscore(df: DataFrame, column: str, threshold: float = ZSCORE_THRESHOLD) -> DataFrame:
    """Add ``<column>_ES_OUTLIER`` by distance from the mean in sample deviations."""
    x = F.col(column).cast("double")
    p = single_row(df.agg(F.avg(x).alias("mean"), F.stddev_samp(x).alias("sd")))
    score = F.abs((x - p["mean"]) / F.nullif(p["sd"], F.lit(0.0)))
    return df.withColumn(column + OUTLIER_SUFFIX, F.coalesce(score > threshold, F.lit(False)))


def mark_outliers(df: DataFrame, column: str, method: str = "iqr") -> DataFrame:
    """Mark outliers of one column with the named method; no row is removed."""
    methods = {"iqr": outliers_iqr, "zscore": outliers_zscore}
    if method not in methods:
        raise ValueError(f"unknown outlier method '{method}', expected one of {sorted(methods)}")
    return methods[method](df, column)


def outlier_counts(marked: DataFrame) -> DataFrame:
    """(column, outliers, rows, percent) from the flag columns of ``marked``."""
    flags = [c for c in marked.columns if c.endswith(OUTLIER_SUFFIX)]
    totals = marked.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c)).alias(c) for c in flags]
    )
    pairs = F.array(
        *[
            F.struct(F.lit(c.removesuffix(OUTLIER_SUFFIX)).alias("column"), F.col(c).alias("outliers"))
            for c in flags
        ]
    )
    return totals.select("rows", F.inline(pairs)).select(
        "column",
        "outliers",
        "rows",
        (100.0 * F.col("outliers") / F.greatest(F.col("rows"), F.lit(1))).alias("percent"),
    )


def clean(df: DataFrame) -> DataFrame:
    """Impute and mark in one step: the fences and the median come from ``df`` itself."""
    return apply_cleaning(df, settled_fit(df))


def cleaning_report(df: DataFrame, mcar: DataFrame | None = None) -> DataFrame:
    """(metric, column, value) rows describing what ``clean`` does to ``df``.

    ``mcar`` is the (column, p_value) result of ``missingness.mcar_report``.
    """
    params = settled_fit(df)
    entries = []

    def entry(metric: str, column: str | None, value: Column) -> None:
        entries.append(
            F.struct(
                F.lit(metric).alias("metric"),
                F.lit(column).cast("string").alias("column"),
                value.cast("string").alias("value"),
            )
        )

    entry("rows_before", None, F.col("rows"))
    entry("rows_after", None, F.col("rows"))
    for c in df.columns:
        entry("missing_before", c, F.when(F.col(f"nulls_{c}") > 0, F.col(f"nulls_{c}")))
    for c in _present(df, MEDIAN_IMPUTED):
        text = F.format_string(TREATMENT_MEDIAN, F.col(f"median_{c}"))
        entry("missing_treatment", c, F.when(F.col(f"nulls_{c}") > 0, text))
    for c in _present(df, NEVER_IMPUTED):
        entry("missing_treatment", c, F.when(F.col(f"nulls_{c}") > 0, F.lit(TREATMENT_NONE)))
    report = params.select(F.inline(F.array(*entries))).where("value is not null")

    flagged = _present(df, OUTLIER_COLUMNS)
    if flagged:
        counted = outlier_counts(apply_cleaning(df.select(*flagged), params))
        found = F.array(
            F.struct(
                F.lit("outliers_detected").alias("metric"),
                F.col("column"),
                F.col("outliers").cast("string").alias("value"),
            ),
            F.struct(
                F.lit("outliers_treatment").alias("metric"),
                F.col("column"),
                F.lit(TREATMENT_FLAGGED).alias("value"),
            ),
        )
        report = report.unionByName(counted.select(F.inline(found)))
    if mcar is not None:
        report = report.unionByName(
            mcar.select(
                F.lit("mcar_test_pvalue").alias("metric"),
                "column",
                F.format_string("%.6f", F.col("p_value")).alias("value"),
            )
        )
    return report

