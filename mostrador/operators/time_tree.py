"""A tree of time segments: every range of times is the union of a few of its nodes.

The bounds that are asked about lie on a grid (of days, hours, ... or microseconds, the
coarsest they all fit). A segment is either one point of the grid or the open stretch
between two, so a bound, whether it belongs to its range or not, always falls between segments.
Four consecutive segments form a node of the next level, and so on; the segments of a
range are covered by at most six nodes a level. Which node holds a time is arithmetic on the time,
so nothing is looked up: the tree is never stored, and only the nodes asked for are filled.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ARITY_BITS = 2
# Node of all rows, those without a time included.
ALL_LEVEL = -1
# Microseconds of a day, an hour, a minute, a second, a millisecond, and one.
UNITS = (86_400_000_000, 3_600_000_000, 60_000_000, 1_000_000, 1_000, 1)
_NODES = "array<struct<level:int,idx:bigint>>"


class TimeGrid(NamedTuple):
    """Grid of ``unit`` microseconds; ``segments`` of them from number ``base``; the outermost ones reach to the ends of time."""

    unit: int
    base: int
    segments: int

    @property
    def levels(self) -> int:
        """Levels above which no two segments are told apart."""
        return max(1, -(-max(0, self.segments - 1).bit_length() // ARITY_BITS))


def micros(at: Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, whatever the session's zone."""
    days = F.unix_date(at.cast("date")).cast("bigint")
    seconds = (F.hour(at) * 3600 + F.minute(at) * 60).cast("bigint") * 1_000_000
    return days * UNITS[0] + seconds + (F.extract(F.lit("SECOND"), at) * 1_000_000).cast("bigint")


def fit_grid(ranges: DataFrame, low: str = "desde", high: str = "hasta") -> TimeGrid | None:
    """The grid of all bounds of ``ranges``; None where there is no bound. One small row comes to the driver."""
    bounds = ranges.select(F.explode(F.array(micros(F.col(low)), micros(F.col(high)))).alias("at"))
    found = bounds.agg(
        F.min("at").alias("first"), F.max("at").alias("last"), *[F.max(F.pmod("at", F.lit(u))).alias(f"u{u}") for u in UNITS]
    ).first()
    if found["first"] is None:
        return None
    unit = next(u for u in UNITS if found[f"u{u}"] == 0)
    # One segment before the first bound and one after the last take all earlier and later times.
    base, last = 2 * (found["first"] // unit) - 1, 2 * (found["last"] // unit) + 1
    return TimeGrid(unit, base, last - base + 1)


def _number(at: Column, grid: TimeGrid) -> Column:
    unit = F.lit(grid.unit)
    rest = F.pmod(at, unit)
    return F.call_function("div", at - rest, unit) * 2 + (rest != 0).cast("bigint") - grid.base


def segment(at: Column, grid: TimeGrid) -> Column:
    """The segment that holds a time; NULL for no time."""
    return F.greatest(F.lit(0), F.least(_number(micros(at), grid), F.lit(grid.segments - 1))) + F.when(at.isNotNull(), 0)


def node_at(cell: Column, level: int) -> Column:
    """The node of ``level`` above a segment."""
    return F.shiftright(cell, ARITY_BITS * level)


def node_span(level: Column, idx: Column) -> tuple[Column, Column]:
    """The first and the last segment under a node."""
    bits = level * ARITY_BITS
    return F.call_function("shiftleft", idx, bits), F.call_function("shiftleft", idx + 1, bits) - 1


def add_covering_nodes(ranges: DataFrame, grid: TimeGrid | None, low: str = "desde", high: str = "hasta") -> DataFrame:
    """``ranges`` with ``nodes``, the nodes (level, idx) that make up each range of times, both bounds included.

    A NULL bound is an open end; without any bound the range has the one node of all rows.
    """
    everything = F.array(F.struct(F.lit(ALL_LEVEL).alias("level"), F.lit(0).cast("bigint").alias("idx"))).cast(_NODES)
    if grid is None:
        return ranges.withColumn("nodes", everything)
    start = F.coalesce(_number(micros(F.col(low)), grid), F.lit(0))
    end = F.coalesce(_number(micros(F.col(high)), grid) + 1, F.lit(grid.segments))
    bounded = ranges.withColumns({"_start": start.cast("bigint"), "_end": end.cast("bigint")})

    def whole(level: Column) -> tuple[Column, Column]:
        """First node of a level inside the range, and the first one after those."""
        bits = level * ARITY_BITS
        above = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1
        return F.call_function("shiftright", F.col("_start") + above, bits), F.call_function("shiftright", F.col("_end"), bits)

    def run(level: Column, first: Column, after: Column) -> Column:
        indices = F.when(after > first, F.sequence(first, after - 1)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(indices, lambda i: F.struct(level.cast("int").alias("level"), i.alias("idx")))

    def of_level(level: Column) -> Column:
        """The whole nodes of a level, less those that make up whole nodes of the next one."""
        (first, after), (up, down) = whole(level), whole(level + 1)
        split = (level < grid.levels) & (up < down)
        lower = run(level, first, F.when(split, up * (1 << ARITY_BITS)).otherwise(after))
        return F.concat(lower, run(level, F.when(split, down * (1 << ARITY_BITS)).otherwise(after), after))

    covered = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(grid.levels)), of_level)).cast(_NODES)
    unbounded = F.col(low).isNull() & F.col(high).isNull()
    return bounded.select(*ranges.columns, F.when(unbounded, everything).otherwise(covered).alias("nodes"))
