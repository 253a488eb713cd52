"""Improbable-feature fingerprints of documents.

A feature is a window of ``WINDOW`` bytes. Its entropy is computed for every position;
how rare that entropy is among all windows of the corpus gives its rank, the rarest
first (``fit_rarity``, one small aggregate that can be kept and used again). Windows of
too little or too much entropy say nothing and have no rank. Of every ``NEIGHBOURS``
windows in a row the lowest rank, leftmost among equals, is marked; windows marked
often enough are the document's features. They go, in order and each once, into Bloom
filters of 256 bytes, ``PER_FILTER`` to a filter, chained as long as needed. Two
fingerprints are compared filter by filter by the bits they share, less what chance
would share, over the most they could share.

Texts are put behind ``WINDOW - 1`` zero bytes, so that short ones have windows too.

Edge cases: a null or empty text has the empty fingerprint; two empty ones are alike
(1), an empty one and another are not (0). Rows without an id belong to no order and
have no edited text; with equal ids, the order among them is that of their texts.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 32
NEIGHBOURS = 32
LEAST_MARKS = 8
PER_FILTER = 128
FILTER_BYTES = 256
BINS = 1000  # entropy in thousandths of its most
LOW, HIGH = 120, 990  # entropies outside have no rank
_SCALE = 1 << 16
_CHUNK = 1 << 16  # windows looked at together
_SLICE = 250  # documents compared at once

_counts = np.arange(WINDOW + 1, dtype=np.float64)
# c * log2(c) in fixed point, and its steps: integers, so sums do not depend on their order.
_TERM = np.rint(_SCALE * _counts * np.log2(np.maximum(_counts, 1))).astype(np.int64)
_STEP = np.diff(_TERM).astype(np.int32)
_MOST = int(_TERM[WINDOW])
_PER_BIN = BINS / _MOST
_BITS = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_ODD = np.cumprod(np.full(WINDOW, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)


def _entropies(data: np.ndarray) -> np.ndarray:
    """The entropy bin of each window of ``data``, which has at least one."""
    windows = len(data) - WINDOW + 1
    same_after = np.zeros(len(data), np.uint8)
    same_before = np.zeros(len(data), np.uint8)
    for lag in range(1, WINDOW):
        equal = (data[:-lag] == data[lag:]).view(np.uint8)
        same_after[:-lag] += equal
        same_before[lag:] += equal
    first = int(_TERM[np.bincount(data[:WINDOW], minlength=256)].sum())
    # From one window to the next, the first byte leaves and one byte enters.
    steps = _STEP[same_before[WINDOW:]] - _STEP[same_after[: windows - 1]]
    sums = np.empty(windows, np.int64)
    sums[0] = first
    np.cumsum(steps, out=sums[1:])
    sums[1:] += first
    return ((_MOST - sums) * _PER_BIN).astype(np.int16)


def _padded(text: bytes) -> np.ndarray:
    return np.frombuffer(bytes(WINDOW - 1) + text, np.uint8)


def _window_entropies(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Entropies of all windows, some at a time, so a very long text needs little memory."""
    windows = len(data) - WINDOW + 1
    for at in range(0, windows, _CHUNK):
        yield at, _entropies(data[at : min(windows, at + _CHUNK) + WINDOW - 1])


def _together(texts: list[bytes], least: int) -> Iterator[list[int]]:
    """Places of texts of ``least`` bytes or more, in groups of about ``_CHUNK`` bytes; long ones are left out."""
    held, size = [], 0
    for k, text in enumerate(texts):
        if least <= len(text) <= _CHUNK:
            if size + len(text) > _CHUNK and held:
                yield held
                held, size = [], 0
            held.append(k)
            size += len(text) + WINDOW
    if held:
        yield held


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts end to end, each behind its zero bytes, and where each begins; a text has as many windows as bytes."""
    pad = bytes(WINDOW - 1)
    starts = np.cumsum([0, *(len(t) + WINDOW - 1 for t in texts[:-1])])
    return np.frombuffer(b"".join([x for t in texts for x in (pad, t)]), np.uint8), starts


def entropy_counts(texts: list[str | None]) -> np.ndarray:
    found = np.zeros(BINS + 1, np.int64)
    raw = [(t or "").encode() for t in texts]
    for members in _together(raw, 1):
        data, starts = _joined([raw[k] for k in members])
        own = _entropies(data)
        for k, start in zip(members, starts.tolist()):
            found += np.bincount(own[start : start + len(raw[k])], minlength=BINS + 1)
    for text in raw:
        if len(text) > _CHUNK:
            for _, some in _window_entropies(_padded(text)):
                found += np.bincount(some, minlength=BINS + 1)
    return found


def fit_rarity(docs: DataFrame, text: str = "text") -> list[int]:
    """How often each entropy occurs in all windows of all documents: ``BINS + 1`` numbers."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BINS + 1, np.int64)
        for batch in batches:
            total += entropy_counts(batch.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BINS + 1, dtype=np.int32)), pa.array(total)], ["bin", "n"])

    counts = docs.select(text).mapInArrow(counted, "bin int, n bigint").groupBy("bin").agg(F.sum("n").alias("n"))
    out = [0] * (BINS + 1)
    for row in counts.collect():  # one row per bin
        out[row["bin"]] = row["n"]
    return out


def ranks_of(rarity: list[int]) -> np.ndarray:
    """The rank of each entropy bin, 1 for the rarest; 0 where there is none."""
    ranks = np.zeros(BINS + 1, np.int64)
    allowed = np.arange(LOW, HIGH + 1)
    order = np.lexsort((allowed, np.array(rarity)[allowed]))
    ranks[allowed[order]] = 1 + np.arange(len(allowed))
    return ranks


def _selected(ranks: np.ndarray) -> np.ndarray:
    """Positions whose rank is the lowest of ``NEIGHBOURS`` in a row at least ``LEAST_MARKS`` times."""
    n = len(ranks)
    worst = BINS + 2
    together = min(NEIGHBOURS, n)
    marks = np.zeros(n, np.int32)
    for at in range(0, n - together + 1, _CHUNK):
        some = ranks[at : min(n, at + _CHUNK + together - 1)].astype(np.int64)
        size = len(some)
        least, width = np.where(some > 0, some, worst) * size + np.arange(size), 1
        while width < together:
            step = min(width, together - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        rank, place = np.divmod(least, size)
        marks[at : at + size] += np.bincount(place[rank < worst], minlength=size).astype(np.int32)
    return np.flatnonzero(marks >= (LEAST_MARKS if n >= NEIGHBOURS + LEAST_MARKS else 1))


def _features(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A hash of the window at each place."""
    mixed = np.zeros(len(places), np.uint64)
    for i in range(WINDOW):
        mixed += (data[places + i].astype(np.uint64) + np.uint64(1)) * _ODD[i]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def _filters(features: np.ndarray) -> bytes:
    _, first = np.unique(features, return_index=True)
    features = features[np.sort(first)]
    number = np.arange(len(features)) // PER_FILTER
    bits = np.zeros((int(number[-1]) + 1, FILTER_BYTES * 8), bool)
    for k in range(5):
        bits[number, ((features >> np.uint64(11 * k)) & np.uint64(2047)).astype(np.int64)] = True
    return np.packbits(bits, axis=1).tobytes()


def fingerprint(text: str | None, ranks: np.ndarray) -> bytes:
    """The chained filters of one whole text, end to end."""
    if not text:
        return b""
    data = _padded(text.encode())
    own = np.empty(len(data) - WINDOW + 1, np.int16)
    for at, some in _window_entropies(data):
        own[at : at + len(some)] = ranks[some]
    places = _selected(own)
    if not len(places):
        places = np.array([len(data) - WINDOW])  # no window has a rank: the last one stands for the text
    return _filters(_features(data, places))


def fingerprint_many(texts: list[str | None], ranks: np.ndarray) -> list[bytes]:
    """``fingerprint`` of each text; texts of usual length are looked at together."""
    raw = [(t or "").encode() for t in texts]
    out: list[bytes | None] = [None] * len(texts)
    shifted = (np.where(ranks > 0, ranks, BINS + 2) << 17).astype(np.int32)
    for members in _together(raw, NEIGHBOURS + LEAST_MARKS):
        data, starts = _joined([raw[k] for k in members])
        least = shifted[_entropies(data)]
        least |= np.arange(len(least), dtype=np.int32)
        width = 1
        while width < NEIGHBOURS:
            step = min(width, NEIGHBOURS - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        within = np.zeros(len(least), bool)  # neighbours of one text
        sizes = [len(raw[k]) for k in members]
        for start, size in zip(starts.tolist(), sizes):
            within[start : start + size - NEIGHBOURS + 1] = True
        least = least[within & (least < (BINS + 2) << 17)]
        places = np.flatnonzero(np.bincount(least & ((1 << 17) - 1)) >= LEAST_MARKS) if len(least) else np.zeros(0, np.int64)
        features = _features(data, places)
        edges = np.searchsorted(places, np.append(starts, len(data))).tolist()
        for k, a, b in zip(members, edges, edges[1:]):
            if a < b:
                out[k] = _filters(features[a:b])
    return [fingerprint(t, ranks) if x is None else x for t, x in zip(texts, out)]


def likeness(one: bytes, other: bytes) -> float:
    """0 to 1: the mean, over the filters of the shorter fingerprint, of the best overlap with one of the other's."""
    if one == other:
        return 1.0
    if not one or not other:
        return 0.0
    if len(one) > len(other):
        one, other = other, one
    a = np.frombuffer(one, np.uint8).reshape(-1, FILTER_BYTES)
    b = np.frombuffer(other, np.uint8).reshape(-1, FILTER_BYTES)
    set_b = _BITS[b].sum(1, dtype=np.int64)
    total = weight = 0.0
    for row in a:
        own = int(_BITS[row].sum(dtype=np.int64))
        shared = _BITS[row & b].sum(1, dtype=np.int64)
        most = np.minimum(own, set_b)
        chance = own * set_b / (8.0 * FILTER_BYTES)
        overlap = np.where(most > chance, (shared - chance) / np.maximum(most - chance, 1e-9), 0.0)
        total += own * float(np.clip(overlap, 0.0, 1.0).max())
        weight += own
    return total / weight


def encoded(print_: bytes) -> str:
    return base64.b64encode(print_).decode()


def fingerprints(docs: DataFrame, rarity: list[int], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` (base64) of every whole text."""
    ranks = ranks_of(rarity)

    @F.arrow_udf("string")
    def made(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(list(map(encoded, fingerprint_many(batch.to_pylist(), ranks))), pa.string())

    return docs.select(F.col(doc_id).alias("doc_id"), made(F.col(text)).alias("fingerprint"))


_EDITED_SQL = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def edited_fingerprints(docs: DataFrame, rarity: list[int]) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likenesses.

    The edited text has its last half (rounded down) replaced by as many characters of
    the next document, in descending order of ids; after the last comes the first.
    Documents are dealt out by ranges of ids whose ends are ids of documents, so each
    range knows which document follows its last: that one is sent to both. Texts are
    shuffled once and no window spans the whole table.
    """
    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranks = ranks_of(rarity)
    known = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # Which ids begin a range decides the balance only, so they need not be exact.
    cuts = [k / ranges for k in range(1, ranges)] or [0.5]
    seen = known.agg(F.percentile_approx("doc_id", cuts, 10_000).alias("ends"), F.max("doc_id").alias("top")).first()
    ends = sorted(set(seen["ends"] or []))  # as many as ranges
    top = seen["top"]
    # Range r holds the ids above ends[r - 1] up to ends[r]; descending, ends[r - 1] is what follows it.
    bounds = np.array(ends, np.int64)

    @F.arrow_udf("array<struct<part: int, after: int>>")
    def targets(ids: pa.Array) -> pa.Array:
        out = []
        for doc, own in zip(ids.to_pylist(), np.searchsorted(bounds, ids.to_numpy(zero_copy_only=False)).tolist()):
            parts = [{"part": own, "after": 0}]
            if own < len(ends) and doc == ends[own]:
                parts.append({"part": own + 1, "after": 1})
            if doc == top:  # the first of all documents follows the last one
                parts.append({"part": 0, "after": 2})
            out.append(parts)
        return pa.array(out, pa.list_(pa.struct([("part", pa.int32()), ("after", pa.int32())])))

    dealt = (
        known.where(F.col("doc_id").isNotNull())
        .select("doc_id", "text", F.explode(targets("doc_id")).alias("t"))
        .select(F.col("t.part").alias("part"), F.col("t.after").alias("after"), "doc_id", "text")
        .repartitionById(len(ends) + 1, F.col("part"))
        .sortWithinPartitions("part", "after", F.col("doc_id").desc(), "text")
    )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int, str, bytes] | None = None  # a document whose next one has not been seen
        ended = False
        for batch in batches:
            if ended:
                continue  # Spark expects its input to be read
            for at in range(0, batch.num_rows, _SLICE):
                afters, ids, texts = (batch.column(i).slice(at, _SLICE).to_pylist() for i in (1, 2, 3))
                own = next(i for i, x in enumerate(afters) if x) + 1 if any(afters) else len(afters)  # one that follows the range, at most
                prints = fingerprint_many(texts[:own], ranks)
                rows = ([last] if last else []) + list(zip(ids[:own], texts[:own], prints))
                if len(rows) > 1:
                    yield _compared(rows, ranks)
                last, ended = rows[-1], own < len(afters) or any(afters)
                if ended:
                    break

    with_order = dealt.mapInArrow(compared, _EDITED_SQL)
    unordered = known.where(F.col("doc_id").isNull()).select("doc_id", F.length("text").cast("bigint").alias("n_chars"), "text")

    @F.arrow_udf("string")
    def made(texts: pa.Array) -> pa.Array:
        return pa.array(list(map(encoded, fingerprint_many(texts.to_pylist(), ranks))), pa.string())

    nothing = F.lit(None)
    return with_order.unionByName(
        unordered.select(
            "doc_id",
            "n_chars",
            nothing.cast("string").alias("edited_sha256"),
            made("text").alias("fingerprint"),
            nothing.cast("string").alias("edited_fingerprint"),
            nothing.cast("double").alias("near_edited"),
            nothing.cast("double").alias("near_next"),
        )
    )


def _compared(rows: list[tuple[int, str, bytes]], ranks: np.ndarray) -> pa.RecordBatch:
    """Each of the rows, but the last, beside the one after it."""
    edited = []
    for (_, text, _), (_, following, _) in zip(rows, rows[1:]):
        half = len(text) // 2
        edited.append(text[: len(text) - half] + following[:half])
    prints = fingerprint_many(edited, ranks)
    out = []
    for (doc, text, own), (_, _, after), new, new_print in zip(rows, rows[1:], edited, prints):
        digest = hashlib.sha256(new.encode()).hexdigest()
        near = (likeness(own, new_print), likeness(own, after))
        out.append((doc, len(text), digest, encoded(own), encoded(new_print), *near))
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [x.split(" ")[0] for x in _EDITED_SQL.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
