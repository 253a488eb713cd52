"""Is a value missing at random? A rank test of a probe column between the two groups.

The test is the two-sided Mann-Whitney U with mid-ranks, tie correction and
continuity correction (the normal approximation). Ranks need the number of
smaller values for every distinct value; that running count is assembled from
bucket totals, so no task ever ranks the whole column.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mostrador.operators.histogram import coarse_bucket, fine_bucket
from mostrador.schema import MEASURE, MEDIAN_IMPUTED

_BEFORE = (Window.unboundedPreceding, -1)


def _before(n: str, window) -> F.Column:
    return F.coalesce(F.sum(n).over(window.rowsBetween(*_BEFORE)), F.lit(0))


def _with_smaller_counts(hist: DataFrame) -> DataFrame:
    """Add ``smaller``: how many rows have a value below this distinct value."""
    placed = hist.withColumn("bucket", coarse_bucket(F.col("value")))
    # At most about 270,000 coarse buckets exist, so ordering them in one place
    # and broadcasting the result has a fixed cost.
    coarse = placed.groupBy("bucket").agg(
        F.sum("n").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    everything = Window.partitionBy(F.lit(0)).orderBy("bucket")
    coarse = coarse.select("bucket", "low", "high", _before("n", everything).alias("below_bucket"))
    placed = placed.join(F.broadcast(coarse), "bucket").withColumn(
        "fine", fine_bucket(F.col("value"), F.col("low"), F.col("high"))
    )
    fine = placed.groupBy("bucket", "fine").agg(
        F.sum("n").alias("n"), F.min("value").alias("fine_low"), F.max("value").alias("fine_high")
    )
    inside = Window.partitionBy("bucket").orderBy("fine")
    fine = fine.select("bucket", "fine", "fine_low", "fine_high", _before("n", inside).alias("below_fine"))
    # Once more inside the fine bucket, so that a dense cluster of values is not ranked by one task either.
    placed = placed.join(fine, ["bucket", "fine"]).withColumn(
        "finest", fine_bucket(F.col("value"), F.col("fine_low"), F.col("fine_high"))
    )
    finest = placed.groupBy("bucket", "fine", "finest").agg(F.sum("n").alias("n"))
    within = Window.partitionBy("bucket", "fine").orderBy("finest")
    finest = finest.select("bucket", "fine", "finest", _before("n", within).alias("below_finest"))
    last = Window.partitionBy("bucket", "fine", "finest").orderBy("value")
    return placed.join(finest, ["bucket", "fine", "finest"]).withColumn(
        "smaller", F.col("below_bucket") + F.col("below_fine") + F.col("below_finest") + _before("n", last)
    )


def mann_whitney(df: DataFrame, target: str, probe: str) -> DataFrame:
    """One row: n_missing, n_present, u, z. ``u`` and ``z`` are NULL for groups below two."""
    missing = F.col(target).isNull()
    hist = (
        df.select(F.col(probe).cast("double").alias("value"), missing.alias("missing"))
        .where(F.col("value").isNotNull())
        .groupBy("value")
        .agg(
            F.count_if(F.col("missing")).alias("n_missing"),
            F.count_if(~F.col("missing")).alias("n_present"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    n = F.col("n").cast("double")
    mid_rank = F.col("smaller") + (n + 1) / 2
    sums = _with_smaller_counts(hist).agg(
        F.coalesce(F.sum("n_missing"), F.lit(0)).alias("n_missing"),
        F.coalesce(F.sum("n_present"), F.lit(0)).alias("n_present"),
        F.sum(F.col("n_missing") * mid_rank).alias("rank_sum"),
        F.sum(n * n * n - n).alias("ties"),
    )
    n1, n2 = F.col("n_missing").cast("double"), F.col("n_present").cast("double")
    total = n1 + n2
    u1 = F.col("rank_sum") - n1 * (n1 + 1) / 2
    u = F.greatest(u1, n1 * n2 - u1)
    variance = n1 * n2 / 12 * ((total + 1) - F.col("ties") / (total * (total - 1)))
    enough = (F.col("n_missing") >= 2) & (F.col("n_present") >= 2)
    z = (F.col("u") - n1 * n2 / 2 - 0.5) / F.sqrt(F.nullif(variance, F.lit(0.0)))
    return sums.withColumn("u", F.when(enough, u)).select(
        "n_missing", "n_present", "u", F.when(enough, z).alias("z")
    )


def two_sided_p(z: float) -> float:
    """Probability of a standard normal at least this far out, on both sides."""
    return min(1.0, max(0.0, math.erfc(z / math.sqrt(2.0))))


def mcar_p_value(df: DataFrame, target: str, probe: str = MEASURE) -> float | None:
    """The p-value, or None where a column is absent or a group has fewer than two values."""
    if target not in df.columns or probe not in df.columns:
        return None
    row = mann_whitney(df, target, probe).first()
    if row["u"] is None:
        return None
    # One single probe value: nothing distinguishes the groups.
    return 1.0 if row["z"] is None else two_sided_p(row["z"])


def mcar_report(df: DataFrame, targets: Sequence[str] = MEDIAN_IMPUTED, probe: str = MEASURE) -> DataFrame:
    """(column, p_value) of every imputed column that has missing values and a defined test."""
    rows = []
    for target in targets:
        p = mcar_p_value(df, target, probe)
        if p is not None:
            rows.append((target, p))
    return df.sparkSession.createDataFrame(rows, "column string, p_value double")
