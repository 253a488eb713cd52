"""Token ids in ORC files: run-length encoded stripes, row indexes, Bloom filters on document ids.

``write_tokens`` deals the documents out by ranges of their ids, encodes each range in
order and writes one ORC file per range, so the files' names and rows are in ascending
order of ids. ORC run-length encodes the integers of a stripe; its row indexes and the
Bloom filters on ``doc_id`` let a reader skip stripes and row groups, and stripes are
read in parallel. Each row holds its range and the ids before it within that range;
``ranges`` beside the data holds the ids before each range, one small row per file, so
no global running sum passes through one task.

Edge cases: a null text has only the end id. Rows without a document id come first;
repeated ids are all kept, in order of their text. Empty tables give empty files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mostrador.llm.bpe import id_lists, word_encoder

END_ID = 2
ROWS_PER_INDEX = 1_000
STRIPE_BYTES = 16 << 20
_SLICE = 500  # documents encoded at once


def write_tokens(docs: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID) -> None:
    """Write ``docs`` (doc_id, text) to ``folder`` as described above, one file per range of ids."""
    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    ordered = (
        docs.select("doc_id", "text").repartitionByRange(ranges, *order).sortWithinPartitions(*order, F.col("text").asc())
    )

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = word_encoder(vocabulary), np.array([end_id], "<i4").tobytes()
        before, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                rows = batch.slice(at, _SLICE)
                lists = [ids + end for ids in encoder.encode_many(rows.column(1).to_pylist())]
                sizes = np.array([len(x) // 4 for x in lists], np.int64)
                starts = before + np.cumsum(sizes) - sizes
                before += int(sizes.sum())
                columns = [rows.column(0), pa.array(np.full(len(lists), part, np.int32)), pa.array(starts), pa.array(sizes)]
                yield pa.RecordBatch.from_arrays([*columns, id_lists(lists)], ["doc_id", "part", "before", "n_tokens", "ids"])

    key = docs.schema["doc_id"].dataType.simpleString()
    (
        ordered.mapInArrow(encoded, f"doc_id {key}, part int, before bigint, n_tokens bigint, ids array<int>")
        .write.mode("overwrite")
        .option("compression", "lz4")  # the run-length encoding has done most of it
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.row.index.stride", str(ROWS_PER_INDEX))
        .option("orc.stripe.size", str(STRIPE_BYTES))
        .orc(f"{folder}/data")
    )
    totals = spark.read.orc(f"{folder}/data").groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    # As many rows as files, so one window over them is small.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals.select("part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base")).coalesce(1).write.mode(
        "overwrite"
    ).orc(f"{folder}/ranges")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` from the files; a filter on ``doc_id`` prunes stripes and row groups."""
    data = spark.read.orc(f"{folder}/data")
    ranges = spark.read.orc(f"{folder}/ranges")  # one row per file
    joined = data.join(F.broadcast(ranges), "part", "left")
    return joined.select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids")


def ids_crc32(ids: Column) -> Column:
    """The unsigned CRC-32 of each list as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("bigint")
    def sums(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            ends = batch.offsets.to_numpy()
            held = memoryview(np.ascontiguousarray(batch.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
            yield pa.array([zlib.crc32(held[4 * a : 4 * b]) for a, b in zip(ends[:-1], ends[1:])], pa.int64())

    return sums(ids)
