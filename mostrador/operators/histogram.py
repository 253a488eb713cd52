"""Distributed histograms that make exact order statistics possible without a global sort.

A column is first reduced to its distinct values with their counts, which
combines on the map side, so a value that fills a third of the table costs one
row per task. Distinct values are then placed by two rules that depend on the
value alone and never decrease as the value grows:

* the *coarse* bucket follows the logarithm of the magnitude over its whole range, so
  there are at most about 270,000 of them whatever the data holds, each 1.1 % wide;
* a *fine* bucket cuts a range into about a million equal steps between the smallest
  and the largest value seen in it. It is applied twice, to a coarse bucket and to the fine one
  that is left: together they tell apart all but about a hundred neighbouring numbers, at any magnitude.

Because the rules are deterministic, a recomputed task after an executor loss
places every value where it was before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COARSE_STEPS = 64  # to a doubling
FINE_STEPS = 1 << 20
_LARGEST = 1.7976931348623157e308
_SMALLEST = 5e-324
_OFFSET = 1075 * COARSE_STEPS  # makes the buckets of the smallest numbers positive
_INFINITE_BUCKET = 200_000


def melt(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) rows of the non-null numbers of several columns, in one scan."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("column"), F.col(name).cast("double").alias("value"))
            for name in columns
        ]
    )
    return df.select(F.inline(pairs)).where(F.col("value").isNotNull() & ~F.isnan("value"))


def distinct_counts(values: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per distinct value and group, with its number of occurrences ``n``."""
    return values.groupBy(*by, "value").agg(F.count(F.lit(1)).alias("n"))


def coarse_bucket(value: Column) -> Column:
    """Order-preserving bucket by magnitude, zero in the middle."""
    # Clamped before the logarithm: infinities get a bucket of their own, and zero is not looked at.
    size = F.least(F.greatest(F.abs(value), F.lit(_SMALLEST)), F.lit(_LARGEST))
    steps = F.floor(F.log2(size) * COARSE_STEPS) + _OFFSET
    steps = F.when(F.abs(value) > _LARGEST, F.lit(_INFINITE_BUCKET)).otherwise(steps)
    # Declared non-null, so joining on it adds no filter below the histogram and
    # every branch of a plan can reuse the one shuffle that built it.
    return F.coalesce((F.signum(value) * steps).cast("int"), F.lit(0))


def fine_bucket(value: Column, low: Column, high: Column) -> Column:
    """Order-preserving position of ``value`` between ``low`` and ``high``."""
    share = (value - low) / (high - low)
    return F.when(low < high, F.floor(share * FINE_STEPS)).otherwise(F.lit(0)).cast("int")
