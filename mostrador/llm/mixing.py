"""A mix of sources by target weights: word budgets met by thresholds on a hash, without sorting.

Every document has a fixed place, a hash of its id and text. Sources share a budget by
weight, none beyond ``repeats`` times its own size; what a capped source leaves over is
shared by the others. A source's target is so many whole passes over it and a rest. The
rest goes to the documents whose place lies under a threshold: words are summed by
source and bucket of the place, the bucket in which the budget ends is refined, and
only the few places in that bucket are put in order. A document that would overrun the
budget stays out, and the words still open are offered to the later documents they can
hold, by a second and third threshold nested above the first.

Documents are taken whole, so a source misses its target by at most half of the document
in which its budget ends first: that one is taken after all where this comes nearer than
all that fits. Reruns agree, as places depend on ids and texts alone.

Edge cases: a null or blank text has size 0 and takes part with nothing; a source without
words has target 0; documents without a source are a source of their own, the last one.
Rows alike in id and text share their place and are taken together or not at all. Empty
tables give empty mixes. Only doc_id, source and text are read; further columns are carried by
``mixed_documents``, whatever their names, and otherwise dropped. Texts are counted whole.

Sources are ranked in one window, one row to a source; everything else is spread by
source and bucket. The plan has one row per source and is joined as Spark sees fit: it is a
stored table, so Spark broadcasts it only within its own size limit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mostrador.session import shared_folder

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
ROUNDS = 3
PLACE_BITS = 60
_COARSE, _FINE = 48, 32  # bits below a coarse bucket (4,096 of them) and below a fine one
_END = 1 << PLACE_BITS
_EARLIER = (Window.unboundedPreceding, -1)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def place(doc_id: Column, text: Column) -> Column:
    """Sixty bits of a digest of id and text."""
    named = F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(named), 1, PLACE_BITS // 4), 16, 10).cast("bigint")


def source_key(source: Column) -> Column:
    """The source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id, source, key, size, place`` of every document."""
    doc_id, text = F.col("doc_id"), F.col("text")
    return docs.select(
        doc_id,
        "source",
        source_key(F.col("source")).alias("key"),
        word_count(text).alias("size"),
        place(doc_id, text).alias("place"),
    )


def targets(
    rows: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS
) -> DataFrame:
    """``key, source_size, target, passes, rest`` of every source of ``rows`` (source, key, size).

    Sources by code point, null last, have ``weights`` in turn. A source that would get more
    than ``repeats`` times its size stops there, and the others share the excess by weight.
    ``share`` of all sizes must not exceed ``repeats``.
    """
    sources = rows.groupBy("source", "key").agg(F.sum("size").alias("source_size"))
    ranked = Window.orderBy(F.col("source").asc_nulls_last())
    turn = ((F.row_number().over(ranked) - 1) % len(weights)).cast("int")
    weighed = sources.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), turn)).withColumn(
        "most", F.col("source_size") * repeats
    )
    # Those that fill up first come first. The first one that does not fill up sets the level for all after it.
    filling = Window.orderBy(F.col("most") / F.col("weight"), "key")
    everything = filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = filling.rowsBetween(*_EARLIER)
    filled = weighed.select(
        "*",
        F.coalesce(F.sum("most").over(earlier), F.lit(0)).alias("most_before"),
        F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)).alias("weight_before"),
        (F.sum("source_size").over(everything) * F.lit(float(share))).alias("budget"),
        F.sum("weight").over(everything).alias("weights"),
    )
    left, open_weight = F.col("budget") - F.col("most_before"), F.col("weights") - F.col("weight_before")
    fits = left * F.col("weight") <= F.col("most") * open_weight
    level = F.first(F.when(fits, F.struct(left.alias("left"), open_weight.alias("weight"))), ignorenulls=True).over(everything)
    shared = F.col("level.left") * F.col("weight") / F.col("level.weight")
    return (
        filled.withColumn("level", level)
        .withColumn("target", F.least(F.coalesce(shared, F.lit(0.0)), F.col("most").cast("double")))
        .withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)))
        .select("key", "source_size", "target", "passes", (F.col("target") - F.col("passes") * F.col("source_size")).alias("rest"))
    )


def _boundary(sums: DataFrame, unit: str) -> DataFrame:
    """Per key, the unit in which its budget ends, with the words before it. No row where all fits."""
    before = F.coalesce(F.sum("words").over(Window.partitionBy("key").orderBy(unit).rowsBetween(*_EARLIER)), F.lit(0))
    ends = (F.col("open") >= F.col("before")) & (F.col("open") < F.col("before") + F.col("words"))
    return sums.withColumn("before", before).where(ends)


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """``key, threshold, left, excess`` where a budget ends: what lies under the threshold fits it and leaves ``left``.

    ``excess`` is by how much the budget is overrun if the document at the threshold is taken as well. ``rows`` has key,
    place and size, ``budgets`` key and ``open``. Where all documents fit, the threshold lies above every place.
    """
    coarse, fine = F.shiftright("place", _COARSE), F.shiftright("place", _FINE)
    summed = F.sum("size").alias("words")
    sums = rows.groupBy("key", coarse.alias("coarse")).agg(summed).join(budgets, "key")
    spare = F.col("open") - F.sum("words")
    fitting = sums.groupBy("key", "open").agg(spare.alias("left")).where("left >= 0").select(
        "key", F.lit(_END).alias("threshold"), "left", F.lit(float("inf")).alias("excess")
    )
    wide = _boundary(sums, "coarse").select("key", "coarse", (F.col("open") - F.col("before")).alias("open"))
    inner = rows.withColumn("coarse", coarse).join(wide, ["key", "coarse"])
    narrow = inner.groupBy("key", "open", fine.alias("fine")).agg(summed)
    narrow = _boundary(narrow, "fine").select("key", "fine", (F.col("open") - F.col("before")).alias("open"))
    last = rows.withColumn("fine", fine).join(narrow, ["key", "fine"])
    last = _boundary(last.groupBy("key", "open", "place").agg(summed), "place")
    left = F.col("open") - F.col("before")
    ending = last.select("key", F.col("place").alias("threshold"), left.alias("left"), (F.col("words") - left).alias("excess"))
    return ending.unionByName(fitting)


def _stored(df: DataFrame, folder: str) -> DataFrame:
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.parquet(folder)


def mix_plan(
    rows: DataFrame,
    folder: str,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per source: ``key, source_size, target, passes, cuts``, the nested thresholds with the size each admits."""
    plan = _stored(targets(rows, weights, share, repeats), f"{folder}/targets")
    start = F.struct(F.lit(0).cast("bigint").alias("threshold"), F.col("rest").alias("left"))
    kind = "array<struct<threshold:bigint,most:double,excess:double>>"
    plan = plan.withColumns({"cuts": F.array().cast(kind), "now": start})
    for round_ in range(rounds):
        opened = plan.where("now.left > 0").select("key", F.col("now.threshold").alias("start"), F.col("now.left").alias("open"))
        offered = rows.join(opened, "key").where((F.col("place") >= F.col("start")) & F.col("size").between(F.lit(1), F.col("open")))
        found = thresholds(offered.select("key", "place", "size"), opened.select("key", "open"))
        # Without a row there was nothing to offer: every document not taken yet is longer than what is left.
        threshold = F.coalesce("threshold", F.lit(_END)).alias("threshold")
        cut = F.struct(threshold, F.col("now.left").alias("most"), F.coalesce("excess", F.lit(float("inf"))).alias("excess"))
        after = F.struct(threshold, F.coalesce("left", "now.left").alias("left"))
        still = F.col("now.left") > 0
        plan = _stored(
            plan.join(found, "key", "left").select(
                *[c for c in plan.columns if c not in ("cuts", "now")],
                F.when(still, F.array_append("cuts", cut)).otherwise(F.col("cuts")).alias("cuts"),
                F.when(still, after).otherwise(F.col("now")).alias("now"),
            ),
            f"{folder}/round-{round_}",
        )
    return plan.withColumn("cuts", _closest(F.col("cuts"), F.col("now.left"))).drop("now")


def _closest(cuts: Column, left: Column) -> Column:
    """The cuts as they are, or those up to the one whose own document comes nearer to the target, with that document."""
    best = F.array_min(F.transform(cuts, lambda c, i: F.struct(c["excess"].alias("excess"), i.alias("index"))))
    at = F.get(cuts, best["index"])
    nearer = F.array(F.struct((at["threshold"] + 1).alias("threshold"), at["most"].alias("most"), at["excess"].alias("excess")))
    return F.when(best["excess"] < left, F.concat(F.slice(cuts, F.lit(1), best["index"]), nearer)).otherwise(cuts)


def copies(size: Column, at: Column, passes: Column, cuts: Column) -> Column:
    """How often a document is taken: once per whole pass, and once more where a cut admits it."""
    extra = F.exists(cuts, lambda c: (at < c["threshold"]) & (size <= c["most"]))
    return passes + F.coalesce(extra, F.lit(False)).cast("bigint")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` of every document."""
    folder = shared_folder(docs.sparkSession, "mix")
    rows = _stored(measured(docs), f"{folder}/sizes")
    plan = mix_plan(rows, folder, weights, share, repeats, rounds)
    times = copies(F.col("size"), F.col("place"), F.col("passes"), F.col("cuts"))
    return (
        rows.join(plan, "key")
        .withColumn("copies", times)
        .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` the mix takes, all columns, each as often as it is taken."""
    folder = shared_folder(docs.sparkSession, "mix")
    rows = _stored(measured(docs), f"{folder}/sizes")
    plan = mix_plan(rows, folder, **options)
    doc_id, text = F.col("doc.doc_id"), F.col("doc.text")
    # The row travels as one struct, so that no column of it can clash with the plan's.
    carried = docs.select(F.struct("*").alias("doc")).withColumn("key", source_key(F.col("doc.source")))
    times = copies(word_count(text), place(doc_id, text), F.col("passes"), F.col("cuts"))
    return (
        carried.join(plan, "key")
        .select("doc", F.explode(F.array_repeat(F.lit(1), times.cast("int"))))
        .select("doc.*")
    )
