"""Derived values of one sales line, and the month a line is stored under."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mostrador.schema import AGE_RANGE, FACT_TABLE


def unit_price(amount: Column, units: Column) -> Column:
    """Amount per unit; NULL where no unit was sold."""
    return amount.cast("double") / F.nullif(units, F.lit(0)).cast("double")


def full_years(birth: Column, at: Column) -> Column:
    """Calendar years completed between two dates, by month and day (not by elapsed days)."""
    day_of_year = lambda c: F.month(c) * 100 + F.dayofmonth(c)
    not_yet = (day_of_year(at) < day_of_year(birth)).cast("int")
    return (F.year(at) - F.year(birth) - not_yet).cast("double")


def plausible_age(age: Column) -> Column:
    """The age itself inside the accepted range, else NULL."""
    return F.when(age.between(*AGE_RANGE), age)


def month_label(at: Column) -> Column:
    """``yyyy-MM``, the value the stored table is partitioned by."""
    return F.format_string("%04d-%02d", F.year(at), F.month(at))


def month_name(at: Column) -> Column:
    """Name of the monthly slice a time falls into; NULL for no time."""
    return F.when(at.isNotNull(), F.format_string(FACT_TABLE + "_y%04dm%02d", F.year(at), F.month(at)))


def month_start(at: Column) -> Column:
    return F.trunc(at.cast("date"), "MM").cast("timestamp_ntz")


def month_end(at: Column) -> Column:
    """First instant after the month."""
    return F.add_months(F.trunc(at.cast("date"), "MM"), 1).cast("timestamp_ntz")
