"""Repeated passages, by longest-previous-factor arrays over the suffixes that can matter.

A byte string of ``LENGTH`` bytes that starts in two places is a repeat. A suffix array of
the whole corpus would bring equal strings together; so does a smaller order. Each string
of ``LENGTH`` bytes is put at its *anchor*, the least of the hashes of its runs of
``ANCHOR`` bytes, leftmost among equals. Equal strings have equal anchors at equal
offsets, so only the suffixes at anchors that occur more than once need an order, each
anchor by itself:

1. ``anchors``: for each document, its anchors and the offsets of the strings at each.
2. Anchors that occur once hold no repeat and are dropped by a count.
3. An anchor's surroundings (the bytes of all its strings) that are equal become one row
   with a count. Where all surroundings of an anchor are equal, all its strings repeat.
4. Otherwise the suffixes around one anchor are put in order, offset by offset from right
   to left: the order of suffixes one byte longer is a stable sort of the shorter ones'
   order by that byte, and common-prefix lengths of neighbours follow. A suffix is a
   repeat if a neighbour shares ``LENGTH`` bytes, and a later copy if its run of such
   neighbours holds a smaller position: the longest previous factor.
5. An anchor with more than ``LIMIT`` different surroundings is not put in one task: its
   strings are split by offset into blocks, whose anchor is all that the block's strings have
   in common, and go through 3 and 4 again. A block that is still beyond the limit is halved.
   One that lies within a passage that all share has one surroundings and is settled while
   wide, so only the two blocks at the passage's ends are split on. Of equal surroundings only
   the first goes on, since the others are later copies whatever it is. With one offset to a
   block the surroundings are the string itself and the count decides. Nothing is left out.

With ``words``, runs of so many words that start in two places are repeats as well, however
few bytes they have. Each word becomes the ``WORD_BYTES`` bytes of its hash, so a run of
``words`` words is a string of fixed length again, and the same steps find it in these codes,
where strings, anchors and offsets start at whole words only.
White space between the words may differ. The strings of ``LENGTH`` bytes are looked for
beside them, for text whose words are long or not set apart.

Documents are joined by id and content, so equal and missing ids do no harm.

Edge cases: null and empty texts have no bytes, and texts under ``LENGTH`` bytes no
strings; they are returned as they are. A row that is there twice repeats itself.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mostrador.session import remove_folder, shared_folder

LENGTH = 400
ANCHOR = 64
LIMIT = 20_000  # about 60 MB of surroundings, their order and flags
WORD_BYTES = 8  # of a word's hash

_PART = 1 << 19  # strings of a document looked at together
_TOGETHER = 3_000  # surroundings put in order at once
_PLACES = np.uint64((1 << 20) - 1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

_WORD = re.compile(rb"[^ \t\n\r\x0b\x0c]+")
_BLANKS = [c.encode() for c in map(chr, range(0x3001)) if c.isspace() and c not in " \t\n\r\x0b\x0c"]

Code = Callable[[bytes], bytes]


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, out=out)


_UP, _DOWN = _powers(_BASE, 1 << 20), _powers(_INVERSE, 1 << 20)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


def _plain_blanks(text: bytes) -> bytes:
    """The text with white space beyond ASCII's as blanks; each byte keeps its place."""
    for blank in _BLANKS:
        if blank in text:
            text = text.replace(blank, b" " * len(blank))
    return text


def word_code(text: bytes) -> bytes:
    """The hashes of the text's words, one after the other."""
    return b"".join(map(xxhash.xxh3_64_digest, _plain_blanks(text).split()))


def text_spans(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Where the whole words within spans of the text's ``word_code`` stand in the text."""
    edges = [m.span() for m in _WORD.finditer(_plain_blanks(text))]
    places = [(-(-start // WORD_BYTES), end // WORD_BYTES) for start, end in spans]
    return [(edges[first][0], edges[end - 1][1]) for first, end in places if first < end]


def anchors(
    text: bytes, length: int = LENGTH, anchor: int = ANCHOR, unit: int = 1
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of each anchor, and the least and greatest offset of the strings it holds, in bytes.

    Everything starts and ends at multiples of ``unit`` bytes (1 or 8).
    """
    data = np.frombuffer(text, np.uint8 if unit == 1 else np.uint64)
    length, anchor = length // unit, anchor // unit
    strings = len(data) - length + 1
    places, low, high = [], [], []
    for at in range(0, strings, _PART):
        part = data[at : min(strings, at + _PART) + length - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _UP[: len(part)], out=sums[1:])
        runs = len(part) - anchor + 1
        hashes = (sums[anchor:] - sums[:-anchor]) * _DOWN[:runs]
        hashes ^= hashes >> np.uint64(31)
        hashes *= np.uint64(0xBF58476D1CE4E5B9)
        keyed = (hashes & ~_PLACES) | np.arange(runs, dtype=np.uint64)
        chosen = (_least(keyed, length - anchor + 1) & _PLACES).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
        last = np.concatenate([first[1:] - 1, [len(chosen) - 1]])
        places.append(chosen[first] + at)
        low.append(chosen[first] - last)
        high.append(chosen[first] - first)
    if not places:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(c) * unit for c in (places, low, high))


def block_widths(length: int, anchor: int, unit: int) -> list[int]:
    """Bytes of offsets to a block, halved down to one offset; the widest parts an anchor's offsets in two or more."""
    widths = [unit]
    while 4 * widths[0] <= length - anchor + unit:
        widths.insert(0, 2 * widths[0])
    return widths


def blocks_of(low: int, high: int, width: int, unit: int) -> Iterator[tuple[int, int, int]]:
    """Block number, least and greatest offset of an anchor's strings, ``width`` bytes of offsets to a block."""
    for number in range(low // width, high // width + 1):
        yield number, max(low, number * width), min(high, number * width + width - unit)


def common_key(text: bytes, place: int, number: int, width: int, length: int, unit: int) -> int:
    """A hash of what all strings of a block have in common, and of the block's number."""
    start = place - number * width
    key = xxhash.xxh3_64_intdigest(text[start : start - width + unit + length], seed=number)
    return key - (1 << 64) if key >= 1 << 63 else key


def repeats(
    groups: np.ndarray, surroundings: list[bytes], low: np.ndarray, high: np.ndarray, rank: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """For each surroundings (rows) and offset (columns): does its string stand elsewhere; does it stand earlier?

    ``surroundings`` reach from the greatest offset's string's start to the least one's
    end; groups are numbered in order; ``rank`` orders rows by position.
    """
    n, depth = len(surroundings), int(high.max())
    right = [s[h:] for s, h in zip(surroundings, high.tolist())]
    sizes = np.array([len(r) for r in right])
    widest = int(sizes.max())
    after = np.frombuffer(b"".join(r.ljust(widest, b"\0") for r in right), np.uint8).reshape(n, widest)
    before = np.frombuffer(b"".join(s[:h][::-1].ljust(depth, b"\0") for s, h in zip(surroundings, high.tolist())), np.uint8).reshape(n, depth)
    numbers = groups.tolist()
    order = np.array(sorted(range(n), key=lambda i: (numbers[i], right[i])))
    common = np.zeros(n + 1, np.int64)  # with the one before; the last entry is an end
    if n > 1:
        unlike = after[order[1:]] != after[order[:-1]]
        shared = np.where(unlike.any(1), unlike.argmax(1), widest)
        shared = np.minimum(shared, np.minimum(sizes[order[1:]], sizes[order[:-1]]))
        common[1:n] = np.where(groups[order[1:]] == groups[order[:-1]], shared, 0)
    elsewhere, earlier = np.zeros((n, depth + 1), bool), np.zeros((n, depth + 1), bool)

    def note(offset: int) -> None:
        near = common >= length
        both = near[:-1] | near[1:]
        if both.any():
            starts = np.flatnonzero(~near[:-1])
            least = np.repeat(np.minimum.reduceat(rank[order], starts), np.diff(np.append(starts, len(order))))
            own = (low[order] <= offset) & both
            elsewhere[order[own], offset] = True
            earlier[order[own & (least < rank[order])], offset] = True

    note(0)
    for offset in range(1, depth + 1):
        kept = np.flatnonzero(high[order] >= offset)
        if not len(kept):
            break
        rows = order[kept]
        keys = groups[rows] * 256 + before[rows, offset - 1]
        moved = np.argsort(keys, kind="stable")
        keys, places = keys[moved], kept[moved]
        same = keys[1:] == keys[:-1]
        fresh = np.zeros(len(rows) + 1, np.int64)
        if len(kept) == len(order) and (moved[1:] > moved[:-1]).all():
            fresh[1:-1] = np.where(same, common[1:-1] + 1, 0)
        else:
            which = np.flatnonzero(same)
            if len(which):
                spans = np.column_stack([places[which] + 1, places[which + 1] + 1]).ravel()
                fresh[which + 1] = np.minimum.reduceat(common, spans)[::2] + 1
        order, common = rows[moved], fresh
        note(offset)
    return elsewhere, earlier


_ROW_SQL = "id bigint, rid bigint, place int, low int, high int, key bigint, around binary"
_ROW = pa.schema(
    [
        ("id", pa.int64()),
        ("rid", pa.int64()),
        ("place", pa.int32()),
        ("low", pa.int32()),
        ("high", pa.int32()),
        ("key", pa.int64()),
        ("around", pa.binary()),
    ]
)


def _anchor_rows(docs: DataFrame, length: int, anchor: int, code: Code | None) -> DataFrame:
    """``id, rid, place, low, high, key`` of all anchors of all documents, or of their codes."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for at in range(0, batch.num_rows, 200):
                columns: list[list] = [[] for _ in range(6)]
                for k, text in enumerate(batch.column(2).slice(at, 200).to_pylist(), at):
                    text = text if code is None else code(text)
                    places, low, high = anchors(text, length, anchor, 1 if code is None else WORD_BYTES)
                    digest = xxhash.xxh3_64_intdigest
                    keys = np.array([digest(text[p : p + anchor]) for p in places.tolist()], np.uint64).view(np.int64)
                    for column, values in zip(columns, (np.full(len(places), ids[k]), np.full(len(places), rids[k]), places, low, high, keys)):
                        column.append(values)
                kinds = [f.type for f in _ROW][:6]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c), t) for c, t in zip(columns, kinds)], [f.name for f in _ROW][:6]
                )

    schema = _ROW_SQL.removesuffix(", around binary")
    # A word in a code has a letter and a blank, or more, in the text.
    least = length if code is None else 2 * (length // WORD_BYTES) - 1
    return docs.where(F.octet_length("text") >= least).select("id", "rid", F.col("text").cast("binary")).mapInArrow(found, schema)


def _surroundings(texts: DataFrame, width: int | None, length: int, code: Code | None, whole: bool) -> DataFrame:
    """Rows of the anchors listed beside each text: with a digest of their surroundings, or the bytes if ``whole``.

    With a ``width`` the anchors are split into blocks of so many bytes of offsets, with keys of their own.
    """
    unit = 1 if code is None else WORD_BYTES

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for id_, rid, text, listed in zip(*(batch.column(i).to_pylist() for i in range(4))):
                text = text if code is None else code(text)
                for x in listed:
                    place, low, high, key = x["place"], x["low"], x["high"], x["key"]
                    blocks = [(None, low, high)] if width is None else blocks_of(low, high, width, unit)
                    for number, a, b in blocks:
                        around = text[place - b : place - a + length]
                        own = key if number is None else common_key(text, place, number, width, length, unit)
                        rows.append((id_, rid, place, a, b, own, around if whole else xxhash.xxh3_128_digest(around)))
                        size += len(around) if whole else 64
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ROW)], schema=_ROW)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ROW)], schema=_ROW)

    return texts.select("id", "rid", "text", "listed").mapInArrow(cut, _ROW_SQL)


_FOUND_SQL = "number bigint, spans array<struct<from: int, to: int>>, later array<struct<from: int, to: int>>"
_SPANS = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))


def _runs(flags: np.ndarray, unit: int) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags[::unit].astype(np.int8), [0]]))) * unit
    return [{"from": int(a), "to": int(b) - unit} for a, b in zip(edges[0::2], edges[1::2])]


def _in_order(rows: DataFrame, length: int, unit: int) -> DataFrame:
    """Offsets at which each numbered surroundings repeats another of its key."""

    def settle(held: list[tuple]) -> pa.RecordBatch:
        keys, numbers, low, high, first, around = zip(*held)
        groups = np.cumsum([0, *(a != b for a, b in zip(keys, keys[1:]))])
        position = {f: k for k, f in enumerate(sorted((f["id"], f["rid"], f["place"]) for f in first))}
        rank = np.array([position[f["id"], f["rid"], f["place"]] for f in first])
        elsewhere, earlier = repeats(groups, list(around), np.array(low), np.array(high), rank, length)
        found = [[_runs(row, unit) for row in flags] for flags in (elsewhere, earlier)]
        return pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int64()), pa.array(found[0], _SPANS), pa.array(found[1], _SPANS)], ["number", "spans", "later"]
        )

    def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and row[1] == held[-1][1]:
                    continue  # the same surroundings, from a row that is there twice
                if len(held) >= _TOGETHER and row[0] != held[-1][0]:
                    yield settle(held)
                    held = []
                held.append(row)
        if held:
            yield settle(held)

    return rows.select("key", "number", "low", "high", "first", "around").mapInArrow(ordered, _FOUND_SQL)


_KIND = ["key", "around", "low", "high"]


def _spread_join(rows: DataFrame, table: DataFrame, on: list[str], counted: str, parts: int) -> DataFrame:
    """The stored ``rows`` with what ``table`` holds for them; its ``counted`` is the number of rows to a key.

    Keys with more than a ``4 * parts``-th of all rows are at most ``4 * parts``: those are broadcast
    and their rows stay where they are. All others are shuffled.
    """
    many = rows.count() / (4 * parts)
    hot, rest = table.where(F.col(counted) > many).drop(counted), table.where(F.col(counted) <= many).drop(counted)
    here = rows.join(F.broadcast(hot), on)
    return here.unionByName(rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(rest, on))


def _settled(
    spark: SparkSession, folder: str, rows: DataFrame, texts: DataFrame, length: int, code: Code | None, last: bool
) -> tuple[DataFrame, DataFrame | None]:
    """``id, rid, later, cuts`` of the repeats among ``rows``, and what is beyond the limit: ``id, rid, listed``."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    here = F.struct("id", "rid", "place")
    kinds = rows.groupBy(*_KIND).agg(F.count("*").alias("n"), F.min(here).alias("first"))
    kinds.withColumn("number", F.monotonically_increasing_id()).write.parquet(f"{folder}/kinds")
    kinds = spark.read.parquet(f"{folder}/kinds")
    kinds.groupBy("key").agg(F.count("*").alias("kinds")).where(F.col("kinds") > 1).write.parquet(f"{folder}/keys")
    keys = spark.read.parquet(f"{folder}/keys")
    several, hot = keys.where(F.col("kinds") <= LIMIT), keys.where(F.col("kinds") > LIMIT)
    has_hot = not last and hot.limit(1).count() > 0
    # One text of each different surroundings gives its bytes.
    wanted = _spread_join(kinds, several, ["key"], "kinds", parts).select(
        "first.id", "first.rid", "first.place", "low", "high", "key", "number", "first"
    )
    spot = F.struct("place", "low", "high", "key")
    listed = wanted.groupBy("id", "rid").agg(F.collect_list(spot).alias("listed"))
    bytes_ = _surroundings(texts.drop("listed").join(listed, ["id", "rid"]), None, length, code, whole=True)
    numbered = bytes_.join(wanted, ["id", "rid", "place", "low", "high", "key"])
    dealt = numbered.repartition(parts, "key").sortWithinPartitions("key", "number")
    _in_order(dealt, length, 1 if code is None else WORD_BYTES).write.parquet(f"{folder}/found")
    found = spark.read.parquet(f"{folder}/found")

    def cut(place: Column, low: Column, high: Column) -> Column:
        start, end = place - high, place - low + length
        return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), F.lit(code is not None).alias("coded"))

    # A surroundings that stands twice repeats whole, whatever else has its key. At the last
    # level the surroundings are the string itself, so a key has one kind.
    place, whole = F.col("first.place"), F.array(F.struct(F.col("low").alias("from"), F.col("high").alias("to")))
    decided = kinds.join(found, "number", "left").withColumn("spans", F.when(F.col("n") > 1, whole).otherwise(F.col("spans")))
    decided = decided.where(F.size("spans") > 0).select(
        "first.id",
        "first.rid",
        *(F.transform(c, lambda s: cut(place, s["from"], s["to"])).alias(c) for c in ("spans", "later")),
    )
    # The first of a kind has the kind's spans. All others are later copies as a whole: what a document has beside
    # its firsts, so the places of a document are looked up together, and stay together, and a kind's members need not meet.
    spot_code = (F.col("place").cast("bigint") * length + F.col("low")) * length + F.col("high")
    own = rows.groupBy("id", "rid").agg(F.collect_set(spot_code).alias("spots"))
    firsts = kinds.select("first.id", "first.rid", "first.place", "low", "high").groupBy("id", "rid").agg(F.collect_set(spot_code).alias("firsts"))
    beside = F.array_except("spots", F.coalesce("firsts", F.expr("cast(array() as array<bigint>)")))

    def whole_of(spot: Column) -> Column:
        place_, offsets = F.call_function("div", spot, F.lit(length * length)), spot % (length * length)
        return cut(place_, F.call_function("div", offsets, F.lit(length)), offsets % length)

    copies = own.join(firsts, ["id", "rid"], "left").select("id", "rid", F.transform(beside, whole_of).alias("spans"))
    each = decided.unionByName(copies.withColumn("later", F.col("spans")))
    kind = {"spans": F.lit(False), "later": F.lit(True)}
    everywhere, later = (each.select("id", "rid", flag.alias("later"), F.col(c).alias("cuts")) for c, flag in kind.items())
    spans = everywhere.unionByName(later).where(F.size("cuts") > 0)
    if not has_hot:
        return spans, None
    # Only the first of equal surroundings goes on: it stands for the others.
    left = _spread_join(kinds, hot, ["key"], "kinds", parts).select("first.id", "first.rid", "first.place", "low", "high", "key")
    return spans, left.groupBy("id", "rid").agg(F.collect_set(spot).alias("listed"))


def find_repeats(
    docs: DataFrame, folder: str, length: int = LENGTH, anchor: int = ANCHOR, words: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """The documents as stored in ``folder`` (``id, rid`` and their own columns, ``candidate`` if an anchor of theirs
    occurs elsewhere), and the repeats ``id, rid, later, cuts`` (``start, end, coded``; a document's later copies at one level
    in one row), ``later`` or at all; those that are ``coded`` in the text's ``word_code``."""
    spark = docs.sparkSession
    keyed = docs.withColumns(
        {"id": F.coalesce("doc_id", F.lit(0)).cast("bigint"), "rid": F.xxhash64(F.col("doc_id").isNull(), F.col("text"))}
    )
    ways: dict[str, tuple[int, Code | None]] = {"listed": (length, None)}
    if words is not None:
        ways["listed_words"] = (words * WORD_BYTES, word_code)
    joined = keyed
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for way, (size, code) in ways.items():
        _anchor_rows(keyed, size, min(anchor, size), code).write.parquet(f"{folder}/{way}-anchors")
        rows = spark.read.parquet(f"{folder}/{way}-anchors")
        rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1).write.parquet(f"{folder}/{way}-often")
        shared = _spread_join(rows, spark.read.parquet(f"{folder}/{way}-often"), ["key"], "n", parts)
        listed = shared.groupBy("id", "rid").agg(F.collect_set(F.struct("place", "low", "high", "key")).alias(way))
        joined = joined.join(listed, ["id", "rid"], "left")
    joined = joined.withColumn("candidate", F.coalesce(*ways).isNotNull())
    joined.write.partitionBy("candidate").parquet(f"{folder}/texts")
    texts = spark.read.schema(joined.schema).parquet(f"{folder}/texts")
    for way in ways:
        remove_folder(spark, f"{folder}/{way}-anchors")
        remove_folder(spark, f"{folder}/{way}-often")
    found = None
    for way, (size, code) in ways.items():
        widths = (None, *block_widths(size, min(anchor, size), 1 if code is None else WORD_BYTES))
        candidates = texts.where("candidate").where(F.col(way).isNotNull()).select(
            "id", "rid", F.coalesce("text", F.lit("")).cast("binary").alias("text"), F.col(way).alias("listed")
        )
        for level, width in enumerate(widths):
            own = f"{folder}/{way}/{level}"
            _surroundings(candidates, width, size, code, whole=False).write.parquet(f"{own}/rows")
            rows = spark.read.parquet(f"{own}/rows")
            spans, left = _settled(spark, own, rows, candidates, size, code, level == len(widths) - 1)
            found = spans if found is None else found.unionByName(spans)
            if left is None:
                break
            candidates = candidates.drop("listed").join(left, ["id", "rid"])
    return texts, found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans put together, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def whole_characters_of(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans without the parts of characters at their ends."""
    out = []
    for start, end in spans:
        while start < end and text[start] & 0xC0 == 0x80:
            start += 1
        while end > start and end < len(text) and text[end] & 0xC0 == 0x80:
            end -= 1
        if start < end:
            out.append((start, end))
    return out


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    anchor: int = ANCHOR,
    keep_first: bool = False,
    whole_characters: bool = False,
    words: int | None = None,
) -> DataFrame:
    """All columns of ``docs``, with ``kept`` (the bytes left), ``n_bytes`` and ``spans`` (start and end of what went).

    ``keep_first`` leaves the first copy of each string, by id and place, and removes the later
    ones; ``whole_characters`` leaves characters whole of which only a part repeats; with ``words``,
    repeated runs of so many words go too, of whatever length in bytes.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "repeats")
    own = [c for c in docs.columns if c not in ("kept", "n_bytes", "spans")]
    inner = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"))
    # The text is kept once: beside the other columns, not within them.
    inner = inner.withColumn("row", F.col("row").dropFields("text") if len(own) > 1 else F.col("row"))
    texts, found = find_repeats(inner, folder, length, anchor, words)
    chosen = found.where(F.col("later") == F.lit(keep_first))
    spans = chosen.groupBy("id", "rid").agg(F.flatten(F.collect_list("cuts")).alias("cuts"))
    data = F.coalesce("text", F.lit("")).cast("binary")

    @F.arrow_udf("struct<kept: binary, spans: array<struct<start: int, end: int>>>")
    def without(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for texts_, cuts in batches:
            kept, gone = [], []
            for text, own_ in zip(texts_.to_pylist(), cuts.to_pylist()):
                spans_ = merged([(c["start"], c["end"]) for c in own_ or [] if not c["coded"]])
                runs = merged([(c["start"], c["end"]) for c in own_ or [] if c["coded"]])
                if runs:
                    spans_ = merged(spans_ + text_spans(text, runs))
                if whole_characters:
                    spans_ = whole_characters_of(text, spans_)
                edges = [0, *(x for s in spans_ for x in s), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[0::2], edges[1::2])))
                gone.append([{"start": a, "end": b} for a, b in spans_])
            yield pa.StructArray.from_arrays([pa.array(kept, pa.binary()), pa.array(gone, kind)], ["kept", "spans"])

    rest = [F.col("row")[c].alias(c) if c != "text" else F.col("text") for c in own]
    nothing = F.expr("cast(array() as array<struct<start: int, end: int>>)")
    plain = texts.where("not candidate").select(
        *rest, data.alias("kept"), F.octet_length(data).cast("bigint").alias("n_bytes"), nothing.alias("spans")
    )
    cut = texts.where("candidate").join(spans, ["id", "rid"], "left").withColumn("out", without(data, F.col("cuts")))
    return plain.unionByName(
        cut.select(*rest, F.col("out.kept").alias("kept"), F.octet_length(data).cast("bigint").alias("n_bytes"), F.col("out.spans").alias("spans"))
    )
