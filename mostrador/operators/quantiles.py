"""Exact quantiles with linear interpolation, for any number of groups in one job.

No value list is ever held by one task. The wanted ranks are located in the
coarse buckets, then in the fine ones inside them, once more in the fine ones inside
those, and only the few distinct values that are left per rank are put in order. See ``histogram``.

Located ranks are joined to the histogram, two rows per group and quantile. Where the
groups are a list of columns they are broadcast; any other number of groups is left to
Spark, which broadcasts within its own size limit and shuffles beyond it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mostrador.operators.histogram import coarse_bucket, distinct_counts, fine_bucket, melt

# Values put in order by one task without narrowing them down again.
FEW_VALUES = 1_024
_BEFORE = (Window.unboundedPreceding, -1)


def _before(n: str, window) -> Column:
    return F.coalesce(F.sum(n).over(window.rowsBetween(*_BEFORE)), F.lit(0))


def _coarse(hist: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per coarse bucket: rows and value range."""
    return (
        hist.withColumn("bucket", coarse_bucket(F.col("value")))
        .groupBy(*by, "bucket")
        .agg(F.sum("n").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    )


def _small(df: DataFrame, few_groups: bool) -> DataFrame:
    return F.broadcast(df) if few_groups else df


def _moments(hist: DataFrame, by: Sequence[str], few_groups: bool) -> DataFrame:
    """Per group: rows, sum, range, and the squared distances from the mean.

    Distances are taken from the mean itself, and what its rounding adds is taken
    off again, so a spread is exact however far from zero the values lie.
    """
    totals = hist.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("value")).alias("total"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
    )
    means = totals.select(*by, (F.col("total") / F.col("n")).alias("mean"))
    distance = F.col("value") - F.col("mean")
    spread = (
        hist.join(_small(means, few_groups), by)
        .groupBy(*by)
        .agg(
            F.sum(F.col("n") * distance).alias("first"),
            F.sum(F.col("n") * distance * distance).alias("second"),
        )
    )
    squares = F.col("second") - F.col("first") * F.col("first") / F.col("n")
    return totals.join(spread, by).withColumn("squares", squares).drop("first", "second")


def _locate(coarse: DataFrame, by: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """The bucket, and the rank inside it, of both neighbours of every quantile position."""
    group = Window.partitionBy(*by)
    last = F.col("rows") - 1
    wanted = []
    for i, p in enumerate(probs):
        position = last * F.lit(float(p))
        lower = F.floor(position)
        for side, rank in enumerate((lower, F.least(lower + 1, last))):
            wanted.append(
                F.struct(
                    F.lit(2 * i + side).alias("target"),
                    (rank - F.col("before")).alias("rank"),
                    (position - lower).alias("weight"),
                )
            )
    held = F.filter(F.array(*wanted), lambda t: (t.rank >= 0) & (t.rank < F.col("n")))
    return (
        coarse.withColumn("rows", F.sum("n").over(group))
        .withColumn("before", _before("n", group.orderBy("bucket")))
        .select(*by, "bucket", "low", "high", F.inline(held))
    )


def _inside(hist: DataFrame, targets: DataFrame, by: Sequence[str], few_groups: bool) -> DataFrame:
    """Distinct values that lie in the range a target is still confined to."""
    placed = hist.withColumn("bucket", coarse_bucket(F.col("value")))
    return placed.join(_small(targets, few_groups), [*by, "bucket"]).where(F.col("value").between(F.col("low"), F.col("high")))


def _pick(rows: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """Keep, per target, the row that holds the wanted rank, now counted from that row."""
    window = Window.partitionBy(*by, "target").orderBy(order)
    placed = rows.withColumn("rank", F.col("rank") - _before("n", window))
    return placed.where((F.col("rank") >= 0) & (F.col("rank") < F.col("n")))


def _narrow(hist: DataFrame, targets: DataFrame, by: Sequence[str], few_groups: bool) -> DataFrame:
    """Confine every target to one fine bucket of its range."""
    fine = fine_bucket(F.col("value"), F.col("low"), F.col("high"))
    kept = [*by, "target", "rank", "weight", "bucket"]
    counted = (
        _inside(hist, targets, by, few_groups)
        .groupBy(*kept, fine.alias("fine"))
        .agg(F.sum("n").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"), F.count("*").alias("distinct"))
    )
    return _pick(counted, by, "fine").select(*kept, "low", "high", "distinct")


def _confine(hist: DataFrame, targets: DataFrame, by: Sequence[str], few_groups: bool) -> DataFrame:
    """Targets confined to few distinct values each.

    One narrowing does it unless values are packed very densely; the second one is for those, and where there are
    none Spark finds its input empty and leaves it out.
    """
    once = _narrow(hist, targets, by, few_groups)
    twice = _narrow(hist, once.where(F.col("distinct") > FEW_VALUES).drop("distinct"), by, few_groups)
    return once.where(F.col("distinct") <= FEW_VALUES).unionByName(twice).drop("distinct")


def _resolve(hist: DataFrame, targets: DataFrame, by: Sequence[str], named: Mapping[str, float], few_groups: bool) -> DataFrame:
    """One row per group and a column per quantile, from the few values of the last ranges."""
    found = _pick(_inside(hist, _confine(hist, targets, by, few_groups), by, few_groups), by, "value")
    columns = []
    for i, name in enumerate(named):
        low = F.max(F.when(F.col("target") == 2 * i, F.col("value")))
        high = F.max(F.when(F.col("target") == 2 * i + 1, F.col("value")))
        weight = F.max(F.when(F.col("target") == 2 * i, F.col("weight")))
        # Where nothing is interpolated the value itself is the answer, infinite or not.
        exact = (weight == 0) | (low == high)
        columns.append(F.when(exact, low).otherwise(low + (high - low) * weight).alias(name))
    return found.groupBy(*by).agg(*columns)


def group_quantiles(values: DataFrame, by: Sequence[str], named: Mapping[str, float], few_groups: bool = False) -> DataFrame:
    """Exact quantiles of ``value`` per group: one row per group, one column per name.

    ``few_groups`` says that the number of groups is bounded, such as that of a list of columns.
    """
    by = list(by)
    hist = distinct_counts(values, by)
    targets = _locate(_coarse(hist, by), by, list(named.values()))
    return _resolve(hist, targets, by, named, few_groups)


def group_summary(values: DataFrame, by: Sequence[str], few_groups: bool = False) -> DataFrame:
    """Rows, sum, range, exact median and sample deviation of ``value`` per group.

    ``few_groups`` as in ``group_quantiles``. The source is read once: every statistic comes from the one histogram.
    """
    by = list(by)
    hist = distinct_counts(values, by)
    targets = _locate(_coarse(hist, by), by, [0.5])
    found = _resolve(hist, targets, by, {"median": 0.5}, few_groups).join(_moments(hist, by, few_groups), by)
    deviation = F.when(F.col("low") == F.col("high"), F.lit(0.0)).otherwise(
        F.sqrt(F.greatest("squares", F.lit(0.0)) / (F.col("n") - 1))
    )
    return found.select(*by, "n", "total", "low", "high", "median", deviation.alias("deviation"))


def column_quantiles(df: DataFrame, columns: Sequence[str], named: Mapping[str, float]) -> DataFrame:
    """Exact quantiles of several columns: one row per column that has a value."""
    return group_quantiles(melt(df, columns), ["column"], named, few_groups=True)
