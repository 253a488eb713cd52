"""Derived columns: unit price, age at purchase, purchase frequency, standardised measures."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mostrador.functions import derive
from mostrador.operators.lookup import lookup_by_key
from mostrador.operators.quantiles import column_quantiles
from mostrador.schema import (
    AGE,
    BIRTH_DATE,
    FREQUENCY,
    MEASURE,
    SALE_TIME,
    SCALED_COLUMNS,
    SCALED_SUFFIX,
    UNIT_PRICE,
)
from mostrador.session import cut_lineage

CUSTOMER = "CODIGO_CLIENTE"
RECEIPT = "BOLETA"
UNITS = "UNIDADES"


class Scale(NamedTuple):
    mean: float | None
    sd: float | None

    @property
    def usable(self) -> bool:
        """A constant or empty column has no scale to divide by."""
        return bool(self.sd) and self.sd == self.sd


class FeatureParams(NamedTuple):
    """Scale per column, and the frequency table when it is wanted and not empty."""

    scales: dict[str, Scale]
    frequency: DataFrame | None


def add_unit_price(df: DataFrame) -> DataFrame:
    return df.withColumn(UNIT_PRICE, derive.unit_price(F.col(MEASURE), F.col(UNITS)))


def unit_price_quality(df: DataFrame) -> DataFrame:
    """One row: lines with zero units, and mean and exact median of the unit price."""
    priced = add_unit_price(df.select(MEASURE, UNITS))
    median = column_quantiles(priced, [UNIT_PRICE], {"median": 0.5})
    counts = priced.agg(
        F.count_if(F.col(UNITS) == 0).alias("zero_units"), F.avg(UNIT_PRICE).alias("mean")
    )
    return counts.withColumn("median", median.select("median").scalar())


def add_age(df: DataFrame) -> DataFrame:
    years = derive.full_years(F.col(BIRTH_DATE), F.col(SALE_TIME))
    return df.withColumn(AGE, derive.plausible_age(years))


def age_quality(df: DataFrame) -> DataFrame:
    """One row: ages out of range, mean of the valid ones, how many are valid, all rows."""
    years = derive.full_years(F.col(BIRTH_DATE), F.col(SALE_TIME))
    aged = df.select(years.alias("years"), derive.plausible_age(years).alias("age"))
    return aged.agg(
        F.count_if(F.col("years").isNotNull() & F.col("age").isNull()).alias("invalid"),
        F.avg("age").alias("mean"),
        F.count("age").alias("valid"),
        F.count(F.lit(1)).alias("rows"),
    )


def _frequency_plan(df: DataFrame) -> DataFrame:
    # Spark removes repeated (customer, receipt) pairs before the customer's own
    # shuffle, hashing on both, so a customer with very many lines is spread out.
    return (
        df.where(F.col(CUSTOMER).isNotNull())
        .groupBy(CUSTOMER)
        .agg(F.count_distinct(RECEIPT).alias(FREQUENCY), F.count(F.lit(1)).alias("lines"))
    )


def frequency_table(df: DataFrame) -> DataFrame:
    """The purchase frequency and number of lines per customer, computed once and kept distributed."""
    return cut_lineage(_frequency_plan(df))


def purchase_frequency(df: DataFrame) -> DataFrame:
    """(customer, distinct receipts) over the whole data."""
    return _frequency_plan(df).drop("lines")


def purchase_frequency_summary(df: DataFrame) -> DataFrame:
    """One row: customers, mean and largest frequency."""
    return purchase_frequency(df).agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg(FREQUENCY).alias("mean"),
        F.max(FREQUENCY).alias("largest"),
    )


def add_frequency(df: DataFrame, table: DataFrame | None = None) -> DataFrame:
    """Attach the purchase frequency of the customer; NULL for a line without customer."""
    table = frequency_table(df) if table is None else table
    return lookup_by_key(df, table, CUSTOMER, FREQUENCY, "lines")


def scaling_parameters(df: DataFrame, columns: Sequence[str] = SCALED_COLUMNS) -> DataFrame:
    """(column, mean, sd) in one pass; absent columns are skipped."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "column string, mean double, sd double")
    totals = df.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"mean_{c}") for c in present],
        *[F.stddev_samp(F.col(c).cast("double")).alias(f"sd_{c}") for c in present],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"mean_{c}").alias("mean"),
                F.col(f"sd_{c}").alias("sd"),
            )
            for c in present
        ]
    )
    return totals.select(F.inline(rows))


def fit_scales(df: DataFrame, columns: Sequence[str] = SCALED_COLUMNS) -> dict[str, Scale]:
    """The scaling parameters as numbers: they decide which columns the result has."""
    return {r["column"]: Scale(r["mean"], r["sd"]) for r in scaling_parameters(df, columns).collect()}


def apply_scales(df: DataFrame, scales: dict[str, Scale]) -> DataFrame:
    """Add ``<column>_STD`` for every present column whose scale is usable."""
    new = {
        c + SCALED_SUFFIX: (F.col(c).cast("double") - F.lit(s.mean)) / F.lit(s.sd)
        for c, s in scales.items()
        if c in df.columns and s.usable
    }
    return df.withColumns(new) if new else df


def standardize(df: DataFrame, columns: Sequence[str] = SCALED_COLUMNS) -> tuple[DataFrame, dict[str, Scale]]:
    scales = fit_scales(df, columns)
    return apply_scales(df, scales), scales


def fit_frequency(df: DataFrame) -> DataFrame | None:
    """The frequency table, which stays distributed; None without its columns, or where no line has a customer."""
    if not {CUSTOMER, RECEIPT} <= set(df.columns):
        return None
    table = frequency_table(df)
    return None if table.isEmpty() else table


def fit_features(df: DataFrame, with_frequency: bool = True) -> FeatureParams:
    """Scales and, if wanted, the frequency table."""
    table = fit_frequency(df) if with_frequency else None
    return FeatureParams(fit_scales(df), table)


def apply_features(df: DataFrame, params: FeatureParams) -> DataFrame:
    """Add every feature whose inputs are present, using given parameters only."""
    columns = set(df.columns)
    looked_up = CUSTOMER in columns and params.frequency is not None
    # The lookup may shuffle the rows, so it comes before there are more columns; its own column still follows them.
    if looked_up:
        df = add_frequency(df, params.frequency)
    if {MEASURE, UNITS} <= columns:
        df = add_unit_price(df)
    if {SALE_TIME, BIRTH_DATE} <= columns:
        df = add_age(df)
    if looked_up:
        df = df.select(*[c for c in df.columns if c != FREQUENCY], FREQUENCY)
    return apply_scales(df, params.scales)


def engineer_features(df: DataFrame, with_frequency: bool = True) -> DataFrame:
    """Fit on ``df`` and apply to ``df``."""
    return apply_features(df, fit_features(df, with_frequency))

