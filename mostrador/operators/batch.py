"""Answers to a table of requests: each of the seven statistics from shared histograms over a tree of time.

Sales are reduced once to (filters, segment of time, value) with counts, for the segments that requests
ask for. A request is the union of a few nodes of a tree over the segments, so requests that overlap in time
share their sales instead of being paired with them. Counts, sums, ranges and spreads are merged from
one row per segment, then from one row per node. Medians are searched jointly: values are numbered in order, and every
round each request adds up, over its nodes, how many values fall under each of the 32 next
digits of that number, and keeps the digit that holds its rank. Only counts are lifted to the nodes, never the
values themselves, and only values that some request still looks at go on to the next round. Rows joined are requests
times nodes times at most 32 a round; a round more is needed only for 32 times as many values.

All joins are equality joins between stored tables, so Spark broadcasts a side only within its
own size limit and shuffles otherwise; there is no limit on the number of requests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mostrador import schema as S
from mostrador.operators.filters import EQUALITIES, MONTH_COLUMN
from mostrador.operators.requests import request_bounds
from mostrador.operators.summary import statistics
from mostrador.operators.time_tree import ALL_LEVEL, TimeGrid, add_covering_nodes, fit_grid, node_at, node_span, segment
from mostrador.session import remove_folder, shared_folder

DIGIT_BITS = 5
# The segment of sales without a time, and of all sales of a group that asks for no range of times.
NO_CELL = -1
_CELL = ("group", "cell")
_NODE = ("group", "level", "idx")
_FIELDS = ("n", "total", "low", "high", "median", "deviation")


def _stored(df: DataFrame, folder: str) -> DataFrame:
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.parquet(folder)


def _combinations(bounds: DataFrame) -> DataFrame:
    """Requests with their signature (which equalities they set), its key, and one text for all they ask."""
    names = list(EQUALITIES)
    signature = F.concat(*[F.when(F.col(n).isNotNull(), "1").otherwise("0") for n in names])
    ends = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("desde", "hasta")]
    keyed = bounds.withColumns({"signature": signature, "key": F.concat_ws("|", *[F.col(n) for n in names])})
    return keyed.withColumn("combination", F.concat_ws("/", "signature", "key", *ends)).select(
        "request_id", "possible", "combination", "signature", "key", "desde", "hasta"
    )


def _sales_keys(sales: DataFrame, signatures: Sequence[str], grid: TimeGrid | None, measure: str) -> DataFrame:
    """(cell, value, signature, key): every sale under the key of each signature in use; sales missing a key column drop out."""

    def column(name: str) -> Column:
        spec = EQUALITIES[name]
        return spec.prepared(F.col(spec.column).cast(spec.kind)).cast("string")

    entries = []
    for signature in signatures:
        used = [column(n) for n, bit in zip(EQUALITIES, signature) if bit == "1"]
        key = F.concat(*[x for c in used for x in (F.lit("|"), c)][1:]) if used else F.lit("")
        entries.append(F.struct(F.lit(signature).alias("signature"), key.alias("key")))
    kept = sales.where(F.col(measure).isNotNull() & ~F.isnan(F.col(measure).cast("double")))
    cell = F.lit(None).cast("bigint") if grid is None else segment(F.col("fecha"), grid)
    sources = sorted({EQUALITIES[n].column for s in signatures for n, bit in zip(EQUALITIES, s) if bit == "1"})
    placed = kept.select(cell.alias("cell"), F.col(measure).cast("double").alias("value"), *sources)
    return placed.select("cell", "value", F.inline(F.array(*entries))).where("key is not null")


def within_bounds(sales: DataFrame, ranges: DataFrame) -> DataFrame:
    """The sales no earlier and no later than all ``ranges``; months outside are not read where sales are stored by month."""
    both = ranges.agg(
        F.min("desde").alias("low"), F.max("hasta").alias("high"), F.count_if(F.col("desde").isNull()).alias("from_start"),
        F.count_if(F.col("hasta").isNull()).alias("to_end"),
    ).first()
    for bound, open_, compare in (("low", "from_start", Column.__ge__), ("high", "to_end", Column.__le__)):
        if both[bound] is not None and not both[open_]:
            text = both[bound].isoformat(sep=" ")
            sales = sales.where(compare(F.col("fecha"), F.lit(text).cast("timestamp_ntz")))
            if MONTH_COLUMN in sales.columns:
                sales = sales.where(compare(F.col(MONTH_COLUMN), F.lit(text[:7])))
    return sales


def asked_spans(groups: DataFrame, nodes: DataFrame) -> DataFrame:
    """``groups`` with the first and last segment under their ``nodes`` (NULL if they ask for no range) and whether they ask for all times."""
    ranged = F.col("level") != ALL_LEVEL
    first, last = node_span(F.col("level"), F.col("idx"))
    spans = nodes.groupBy("group").agg(
        F.min(F.when(ranged, first)).alias("first"), F.max(F.when(ranged, last)).alias("last"), F.bool_or(~ranged).alias("everything")
    )
    return groups.join(spans, "group")


def cell_histogram(keyed: DataFrame, groups: DataFrame) -> DataFrame:
    """``group, cell, value, n``: the distinct values of the sales in each segment that ``groups`` (see ``asked_spans``) ask for."""
    asked = F.col("everything") | F.col("cell").between(F.col("first"), F.col("last"))
    cell = F.when(F.col("first").isNotNull() & F.col("cell").isNotNull(), F.col("cell")).otherwise(F.lit(NO_CELL).cast("bigint"))
    placed = keyed.join(groups, ["signature", "key"]).where(asked).select("group", cell.alias("cell"), "value")
    return placed.groupBy(*_CELL, "value").agg(F.count("*").alias("n"))


def _lifted(cells: DataFrame, levels: Sequence[int]) -> DataFrame:
    """Rows of segments as rows of the nodes above them, at most one per level."""
    timed = F.col("cell") != NO_CELL
    above = [
        F.struct(F.lit(k).alias("level"), (F.lit(0).cast("bigint") if k == ALL_LEVEL else F.when(timed, node_at(F.col("cell"), k))).alias("idx"))
        for k in levels
    ]
    rest = [c for c in cells.columns if c != "cell"]
    return cells.select(*rest, F.inline(F.array(*above))).where("idx is not null")


def numbered_values(hist: DataFrame, folder: str) -> tuple[DataFrame, int]:
    """``value, rank`` of the distinct values, numbered in order from 0, and how many there are."""
    ranged = hist.select("value").distinct().repartitionByRange("value").sortWithinPartitions("value")
    placed = _stored(ranged.withColumn("at", F.monotonically_increasing_id()), f"{folder}/values")
    # Identifiers rise along a file, and files follow each other in the order of the ranges: one row per file.
    part = F.shiftright("at", 33).alias("part")
    parts = placed.groupBy(part).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = _stored(parts.select("part", "n", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift")), f"{folder}/parts")
    ranked = placed.withColumn("part", part).join(parts.select("part", "shift"), "part")
    return ranked.select("value", (F.col("at") + F.col("shift")).alias("rank")), parts.agg(F.sum("n")).first()[0] or 0


def cell_moments(hist: DataFrame, folder: str) -> DataFrame:
    """Rows, sum, range and squared distances from the own mean of every segment."""
    totals = hist.groupBy(*_CELL).agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("value")).alias("total"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
    )
    totals = _stored(totals, f"{folder}/cell-totals")
    distance = F.col("value") - F.col("mean")
    spread = (
        hist.join(totals.select(*_CELL, (F.col("total") / F.col("n")).alias("mean")), list(_CELL))
        .groupBy(*_CELL)
        .agg(F.sum(F.col("n") * distance).alias("first"), F.sum(F.col("n") * distance * distance).alias("second"))
    )
    squares = F.col("second") - F.col("first") * F.col("first") / F.col("n")
    return spread.join(totals, list(_CELL)).select(*_CELL, "n", "total", "low", "high", squares.alias("squares"))


def node_moments(cells: DataFrame, nodes: DataFrame, levels: Sequence[int], folder: str) -> DataFrame:
    """The moments of ``nodes`` from those of their segments; spreads are merged about the mean of the node."""
    parts = _lifted(cells, levels).join(nodes, list(_NODE))
    totals = parts.groupBy(*_NODE).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    totals = _stored(totals, f"{folder}/totals")
    apart = F.col("total") / F.col("n") - F.col("mean")
    spread = (
        parts.join(totals.select(*_NODE, (F.col("total") / F.col("n")).alias("mean")), list(_NODE))
        .groupBy(*_NODE)
        .agg(F.sum(F.col("squares") + F.col("n") * apart * apart).alias("squares"))
    )
    return spread.join(totals, list(_NODE)).select(*_NODE, "n", "total", "low", "high", "squares")


def merged_moments(asks: DataFrame, moments: DataFrame) -> DataFrame:
    """``ask, n, total, low, high, deviation`` from the moments of the nodes of every ask: spreads are merged about the common mean."""
    parts = asks.select("ask", "group", F.inline("nodes")).join(moments, list(_NODE))
    each = F.struct("n", "total", "squares")
    merged = parts.groupBy("ask").agg(
        F.sum("n").alias("n"),
        F.sum("total").alias("total"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.collect_list(each).alias("parts"),  # a few nodes per level of the tree
    )
    mean = F.col("total") / F.col("n")

    def added(sum_: Column, part: Column) -> Column:
        apart = part["total"] / part["n"] - mean
        return sum_ + part["squares"] + part["n"] * apart * apart

    squares = F.greatest(F.aggregate("parts", F.lit(0.0), added), F.lit(0.0))
    # No distance from the mean: a single value, or rows that are all the same.
    deviation = F.when(F.col("low") == F.col("high"), F.lit(0.0)).otherwise(F.sqrt(squares / (F.col("n") - 1)))
    return merged.select("ask", "n", "total", "low", "high", deviation.alias("deviation"))


def _chosen(counts: Column, rank: Column) -> Column:
    """Of (digits so far, n) entries, several of which may be alike, the one that holds a rank, and the rank inside it."""
    start = F.struct(
        F.lit(0).cast("bigint").alias("seen"), F.lit(-1).cast("bigint").alias("at"), F.lit(0).cast("bigint").alias("before"),
        F.lit(None).cast("bigint").alias("prefix"), F.lit(None).cast("bigint").alias("rank"),
    )

    def step(a: Column, c: Column) -> Column:
        before = F.when(c["prefix"] == a["at"], a["before"]).otherwise(a["seen"])
        seen = a["seen"] + c["n"]
        here = a["prefix"].isNull() & (rank < seen)
        return F.struct(
            seen.alias("seen"),
            c["prefix"].alias("at"),
            before.alias("before"),
            F.when(here, c["prefix"]).otherwise(a["prefix"]).alias("prefix"),
            F.when(here, rank - before).otherwise(a["rank"]).alias("rank"),
        )

    return F.aggregate(F.array_sort(counts), start, step)


def medians(asks: DataFrame, sizes: DataFrame, hist: DataFrame, levels: Sequence[int], folder: str) -> DataFrame:
    """``ask, median`` of every ask with rows; ``sizes`` has their number ``n``."""
    values, distinct = numbered_values(hist, folder)
    at = f"{folder}/numbered"
    numbered = _stored(hist.join(values, "value").select(*_CELL, "rank", "n"), at)
    rounds = max(1, -(-max(0, distinct - 1).bit_length() // DIGIT_BITS))
    # The middle row, or the two of them.
    middle = F.array(*[F.struct(F.lit(k).alias("side"), F.floor(p).cast("bigint").alias("rank")) for k, p in enumerate(((F.col("n") - 1) / 2, F.col("n") / 2))])
    # Written out once: in the rounds no row carries the list of its nodes.
    paths = _stored(asks.select("ask", "group", F.inline("nodes")), f"{folder}/paths")
    state = sizes.select("ask", F.lit(0).cast("bigint").alias("prefix"), F.inline(middle))
    for round_ in reversed(range(rounds)):
        low = DIGIT_BITS * round_
        state = _stored(state, f"{folder}/search-{round_}")
        digits, prefix = F.shiftright("rank", low).alias("digits"), F.shiftright("rank", low + DIGIT_BITS)
        # Only what some ask still looks at is counted, and read in the next round.
        looked_at = paths.join(state.select("ask", "prefix").distinct(), "ask").select(*_NODE, "prefix").distinct()
        numbered = numbered.withColumn("prefix", prefix)
        if round_ < rounds - 1:
            wanted = _stored(asks.join(state, "ask").select("group", "prefix").distinct(), f"{folder}/wanted-{round_}")
            numbered = numbered.join(wanted, ["group", "prefix"])
            if round_:
                numbered = _stored(numbered, f"{folder}/left-{round_}")
                remove_folder(hist.sparkSession, at)
                at = f"{folder}/left-{round_}"
        inside = numbered.groupBy(*_CELL, "prefix", digits).agg(F.sum("n").alias("n"))
        lifted = _lifted(inside, levels).join(looked_at, [*_NODE, "prefix"])
        counts = lifted.groupBy(*_NODE, "prefix", "digits").agg(F.sum("n").alias("n"))
        met = paths.join(state.select("ask", "side", "prefix"), "ask").join(counts, [*_NODE, "prefix"])
        # Added up over the nodes before they are listed: 32 entries at most.
        added = met.groupBy("ask", "side", "digits").agg(F.sum("n").alias("n"))
        listed = added.groupBy("ask", "side").agg(F.collect_list(F.struct(F.col("digits").alias("prefix"), "n")).alias("counts"))
        state = state.select("ask", "side", "rank").join(listed, ["ask", "side"]).select(
            "ask", "side", _chosen(F.col("counts"), F.col("rank")).alias("at")
        ).select("ask", "side", F.col("at.prefix").alias("prefix"), F.col("at.rank").alias("rank"))
    state = _stored(state, f"{folder}/places")
    found = state.join(values.withColumnRenamed("rank", "prefix"), "prefix").groupBy("ask").agg(
        F.max(F.when(F.col("side") == 0, F.col("value"))).alias("lower"), F.max(F.when(F.col("side") == 1, F.col("value"))).alias("upper")
    )
    between = F.col("lower") + (F.col("upper") - F.col("lower")) * 0.5
    return found.select("ask", F.when(F.col("lower") == F.col("upper"), F.col("lower")).otherwise(between).alias("median"))


def batch_summary(sales: DataFrame, validated: DataFrame, measure: str = S.MEASURE) -> DataFrame:
    """(request_id, seven statistics) for every valid request, in one pass over the sales.

    Requests asking for the same rows are computed once. Sales outside the bounds of all requests are not read.
    """
    spark = sales.sparkSession
    folder = shared_folder(spark, "lote")
    combined = _stored(_combinations(request_bounds(validated)), f"{folder}/requests")
    distinct = combined.where("possible").select("combination", "signature", "key", "desde", "hasta").distinct()
    signatures = sorted(r["signature"] for r in distinct.select("signature").distinct().collect())  # 64 at most
    answers = combined.select("request_id", F.when(F.col("possible"), F.col("combination")).alias("combination"))
    if not signatures:
        empty = {f: F.lit(None).cast("bigint" if f == "n" else "double") for f in _FIELDS}
        return answers.withColumns(empty).select("request_id", *statistics(*[F.col(f) for f in _FIELDS]))
    grid = fit_grid(distinct)
    pairs = distinct.select("signature", "key").distinct()
    groups = _stored(pairs.withColumn("group", F.monotonically_increasing_id()), f"{folder}/groups")
    asks = add_covering_nodes(distinct.join(groups, ["signature", "key"]), grid).select("combination", "group", "nodes")
    asks = _stored(asks.withColumn("ask", F.monotonically_increasing_id()), f"{folder}/asks")
    nodes = _stored(asks.select("group", F.inline("nodes")).distinct(), f"{folder}/nodes")
    levels = sorted(r["level"] for r in nodes.select("level").distinct().collect())  # the height of the tree at most
    groups = _stored(asked_spans(groups, nodes), f"{folder}/spans")
    keyed = _sales_keys(within_bounds(sales, distinct), signatures, grid, measure)
    hist = _stored(cell_histogram(keyed, groups), f"{folder}/histogram")
    cells = _stored(cell_moments(hist, folder), f"{folder}/cells")
    sizes = _stored(merged_moments(asks, node_moments(cells, nodes, levels, folder)), f"{folder}/moments")
    found = sizes.join(medians(asks, sizes, hist, levels, folder), "ask").join(asks.select("ask", "combination"), "ask")
    return answers.join(found, "combination", "left").select("request_id", *statistics(*[F.col(f) for f in _FIELDS]))
