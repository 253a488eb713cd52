"""Near-duplicate documents by MinHash with tensored banding.

A document is its set of distinct shingles of ``words`` words. Instead of the hashes of
``SIDE * SIDE`` independent tables, two collections of ``SIDE`` short keys, of ``ROWS``
minima each, are computed; a table's key is a pair of one key from either collection.
``SIDE * SIDE`` tables of ``2 * ROWS`` minima so cost ``2 * SIDE * ROWS`` hashes, about
the square root. Two sets of similarity s meet in some table unless one collection fails
altogether: at s = 0.8, 12 and 2, that is 2 * 0.36 ** 12, one in 100,000.

1. Sets that are equal become one (the least id stands for them), by an aggregate.
2. Keys that no other set shares are dropped, then pairs of keys are formed and again
   those that only one set has are dropped. Sets of a table hang on its least id, so a
   table of k sets gives k - 1 links, never all pairs.
3. Components of these links are clusters of candidates. A cluster is cut into chunks of
   at most about ``CHUNK`` sets, and every pair of chunks is compared in a task of its own,
   on the full shingle sets, by products of presence matrices. A task gives the links of
   a spanning forest, so the result keeps every connection and never lists all pairs.
4. Components of the confirmed links are the classes.

The pairs of chunks of one cluster grow with the square of its number of *different* sets
over ``CHUNK``: a group of near copies around the threshold can be joined by any of its
pairs, so each pair is looked at once, and none is left out.

Edge cases: null and empty texts have no shingles and are linked with nothing; texts of
fewer words are one shingle. Rows without an id belong to no class and are kept. Rows with
equal ids count as one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mostrador.llm.components import components
from mostrador.session import shared_folder

WORDS = 5
PERCENT = 80
SIDE = 12
ROWS = 2
CHUNK = 128
CHUNK_SHINGLES = 400_000
_COLUMNS = 2_048  # shingles of a presence matrix

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_HASHES = 2 * SIDE * ROWS
_rng = np.random.default_rng(20240607)
_MULTIPLIERS = _rng.integers(0, 1 << 63, _HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _rng.integers(0, 1 << 63, _HASHES, dtype=np.uint64)
_MOST_WORDS = 64
_PLACE = _rng.integers(0, 1 << 63, _MOST_WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of each word of UTF-8 bytes: A-Z lowered, words ended by blank, tab, line ends and feeds."""
    if not len(data):
        return np.zeros(0, np.uint64)
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edges = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    start, end = edges[0::2], edges[1::2]
    if not len(start):
        return np.zeros(0, np.uint64)
    power = np.full(len(data), _BASE, np.uint64)
    power[0] = 1
    np.cumprod(power, out=power)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power, out=sums[1:])
    # Dividing by the power of the first place makes a word's hash independent of where it stands.
    back = np.full(len(data), _INVERSE, np.uint64)
    back[0] = 1
    np.cumprod(back, out=back)
    return _mixed((sums[end] - sums[start]) * back[start])


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of the runs of ``words`` words; of all words, if they are fewer."""
    own = word_hashes(np.frombuffer(text, np.uint8))
    if not len(own):
        return own
    size = min(words, len(own))
    runs = len(own) - size + 1
    total = np.full(runs, np.uint64(size), np.uint64)
    for k in range(size):
        total += own[k : k + runs] * _PLACE[k]
    return np.unique(_mixed(total))


def minima(values: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set that is not empty."""
    best = np.full(_HASHES, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64)
    for at in range(0, len(values), 4096):
        some = values[at : at + 4096]
        np.minimum(best, (some[:, None] * _MULTIPLIERS + _OFFSETS).min(0), out=best)
    return best


def side_keys(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The short keys of the two collections; each also depends on its number."""
    parts = minima(values).reshape(2, SIDE, ROWS)
    numbers = np.arange(2 * SIDE, dtype=np.uint64).reshape(2, SIDE) + np.uint64(1)
    keys = numbers * np.uint64(0xD6E8FEB86659FD93)
    for row in range(ROWS):
        keys = _mixed(keys ^ parts[:, :, row]) + numbers
    return keys[0].view(np.int64), keys[1].view(np.int64)


_SIGNED_SQL = "doc_id {}, n_shingles bigint, h1 bigint, h2 bigint, first array<bigint>, second array<bigint>"


def signatures(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Size, 128-bit hash and short keys of every document's set."""
    key = docs.schema["doc_id"].dataType.simpleString()

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, h1, h2, first, second = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                own = shingles(text or b"", words)
                sizes.append(len(own))
                h1.append(own.sum(dtype=np.uint64).view(np.int64))
                h2.append(_mixed(own + np.uint64(7)).sum(dtype=np.uint64).view(np.int64))
                a, b = side_keys(own) if len(own) else (np.zeros(0, np.int64),) * 2
                first.append(a)
                second.append(b)
            columns = [pa.array(sizes, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64())]
            columns += [pa.array(x, pa.list_(pa.int64())) for x in (first, second)]
            names = ["doc_id", "n_shingles", "h1", "h2", "first", "second"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(signed, _SIGNED_SQL.format(key))


def _shared_keys(sets: DataFrame, side: str) -> DataFrame:
    """``rep`` and those of its keys of one side that another set has too."""
    keys = sets.select("rep", F.explode(side).alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("key")
    # At most SIDE keys a set.
    return keys.join(shared, "key").groupBy("rep").agg(F.collect_list("key").alias(side))


def candidate_links(sets: DataFrame) -> DataFrame:
    """``rep, lead``: each set and the least of each table it shares with others."""
    both = _shared_keys(sets, "first").join(_shared_keys(sets, "second"), "rep")
    tables = both.select("rep", F.explode("first").alias("a"), "second").select(
        "rep", "a", F.explode("second").alias("b")
    ).select("rep", F.xxhash64("a", "b").alias("table"))
    leads = tables.groupBy("table").agg(F.min("rep").alias("lead"), F.count("*").alias("n")).where(F.col("n") > 1)
    return tables.join(leads.select("table", "lead"), "table").where(F.col("rep") != F.col("lead")).select("rep", "lead").distinct()


def linked(texts: list[bytes], sides: list[int], words: int, percent: int) -> list[tuple[int, int]]:
    """Links (position, position) that connect what is connected among the sets, each side against the other
    or, if there is one side, all against all: those with ``100 * common >= percent * union``."""
    sets = [shingles(t, words) for t in texts]
    sizes = np.array([len(s) for s in sets], np.int64)
    if len(sets) < 2:
        return []
    values, which = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    several = np.bincount(which, minlength=len(values)) > 1
    column = np.where(several, np.cumsum(several) - 1, -1)[which]
    owner, column = owner[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    one = np.flatnonzero(np.array(sides) == min(sides))
    other = one if len(set(sides)) == 1 else np.flatnonzero(np.array(sides) != min(sides))
    common = np.zeros((len(one), len(other)), np.float64)
    for low in range(0, int(several.sum()), _COLUMNS):
        a, b = np.searchsorted(column, [low, low + _COLUMNS])
        present = np.zeros((len(sets), _COLUMNS), np.float32)
        present[owner[a:b], column[a:b] - low] = 1
        common += present[one] @ present[other].T
    common = np.rint(common).astype(np.int64)
    union = sizes[one][:, None] + sizes[other][None, :] - common
    close = (100 * common >= percent * union) & (common > 0)
    parent = list(range(len(sets)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(close)):
        x, y = root(int(one[i])), root(int(other[j]))
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((int(one[i]), int(other[j])))
    return out


def confirmed_links(docs: DataFrame, clusters: DataFrame, sizes: DataFrame, words: int, percent: int) -> DataFrame:
    """``u, v``: links between different sets of a cluster, confirmed on their full sets."""
    weighed = clusters.join(sizes, "node")
    totals = weighed.groupBy("component").agg(F.count("*").alias("members"), F.sum("n_shingles").alias("shingles"))
    chunks = F.greatest(
        F.ceil(F.col("members") / CHUNK), F.least(F.ceil(F.col("shingles") / CHUNK_SHINGLES), F.col("members"))
    ).cast("int")
    placed = (
        clusters.join(totals.select("component", chunks.alias("chunks")), "component")
        .withColumn("chunk", F.pmod(F.xxhash64("node", F.lit(5)), F.col("chunks")).cast("int"))
        .select("node", "component", "chunk", "chunks")
    )
    texts = docs.select(F.col("doc_id").alias("node"), F.col("text").cast("binary").alias("text"))
    dealt = (
        texts.join(placed, "node")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            F.xxhash64("component", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("unit"), "chunk", "node", "text"
        )
    )

    def compared(unit: pa.Table) -> pa.Table:
        nodes = unit.column("node").to_pylist()
        found = linked(unit.column("text").to_pylist(), unit.column("chunk").to_pylist(), words, percent)
        kind = unit.schema.field("node").type
        return pa.table({"u": pa.array([nodes[i] for i, _ in found], kind), "v": pa.array([nodes[j] for _, j in found], kind)})

    key = docs.schema["doc_id"].dataType.simpleString()
    return dealt.groupBy("unit").applyInArrow(compared, f"u {key}, v {key}")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "minhash")
    docs = docs.select("doc_id", "text")
    signatures(docs, words).write.parquet(f"{folder}/signatures")
    signed = spark.read.parquet(f"{folder}/signatures")
    counted = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    reps = signed.where(counted).groupBy("h1", "h2", "n_shingles").agg(F.min("doc_id").alias("rep"))
    reps.write.parquet(f"{folder}/sets")
    reps = spark.read.parquet(f"{folder}/sets")
    sets = signed.where(counted).join(reps.select(F.col("rep").alias("doc_id"), "h1", "h2", "n_shingles", "rep"), ["doc_id", "h1", "h2", "n_shingles"])
    sets.select("rep", "n_shingles", "first", "second").dropDuplicates(["rep", "n_shingles"]).write.parquet(f"{folder}/keys")
    sets = spark.read.parquet(f"{folder}/keys")
    clusters = components(candidate_links(sets), "rep", "lead")
    sizes = sets.groupBy(F.col("rep").alias("node")).agg(F.max("n_shingles").alias("n_shingles"))
    confirmed_links(docs, clusters, sizes, words, percent).write.parquet(f"{folder}/links")
    classes = components(spark.read.parquet(f"{folder}/links"), "u", "v")
    of_set = reps.join(classes, reps["rep"] == classes["node"], "left").select(
        "h1", "h2", "n_shingles", F.coalesce("component", "rep").alias("class")
    )
    joined = signed.select("doc_id", "n_shingles", "h1", "h2").join(of_set, ["h1", "h2", "n_shingles"], "left")
    component = F.when(counted, F.col("class")).otherwise(F.col("doc_id"))
    return joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
