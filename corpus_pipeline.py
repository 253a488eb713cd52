"""Corpus preparation as a chain of stages, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mostrador.llm import bpe, decontaminate, lpf_dedup, near_dup, queries, zstd_quality
from mostrador.session import shared_folder

# Passages of over 50 words that stand elsewhere go, however few bytes they have; the 400 bytes of op10 are its own contract.
PASSAGE_WORDS = 51

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject. Fitted on the labelled rows among ``docs``.

    Null and empty texts are scored as empty, very long ones whole; equal texts have one score, so repeated
    rows stay or go together. An empty table stays empty. Further columns are carried along whatever their names.
    """
    queries.long_rows(spark)
    model = zstd_quality.fit(docs, queries.training_labels(spark, sf_dir))
    return docs.where(zstd_quality.score(F.col("text"), model) >= queries.QUALITY_THRESHOLD)


def carried(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, and the other columns within ``row``, where their names clash with nothing."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*others or [F.lit(0).alias("none")]).alias("row"))


def restored(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from rows that were ``carried``."""
    return rows.select(*[F.col(c) if c in ("doc_id", "text") else F.col("row").getField(c).alias(c) for c in docs.columns])


def told_apart(docs: DataFrame) -> tuple[DataFrame, Column]:
    """One row of each repeated row (same id and text), and a key that tells the rows apart and orders them by id.

    Ids that are unique and not null are the key themselves. Otherwise it is made of the id, those
    without one last, and a digest of the text.
    """
    unclear = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where((F.col("n") > 1) | F.col("doc_id").isNull())
    if not unclear.limit(1).count():
        return docs, F.col("doc_id")
    # Flipping the sign bit puts the hexadecimal digits of ids in the order of the ids.
    number = F.lpad(F.hex(F.col("doc_id").cast("bigint").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    key = F.concat(F.coalesce(number, F.lit("none")), F.lit("-"), F.coalesce(F.sha2("text", 256), F.lit("null")))
    return docs.withColumn("row_key", key).dropDuplicates(["row_key"]).drop("row_key"), key


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates: the one with the least id. Rows without an id come after all others.

    Null and empty texts are like nothing and stay; of repeated rows one stays. An empty table stays empty, very long
    texts are compared whole, and further columns are carried along whatever their names.
    """
    queries.long_rows(spark)
    rows, key = told_apart(carried(docs))
    keyed = rows.withColumn("row_key", key)
    found = near_dup.near_duplicates(keyed.select(F.col("row_key").alias("doc_id"), "text"))
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("row_key"))
    return restored(keyed.join(gone, "row_key", "left_anti"), docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document, or place, has already; whole characters go.

    A passage is a run of ``PASSAGE_WORDS`` words, or of ``lpf_dedup.LENGTH`` bytes for text whose words are long.
    Of a row that is there several times one is left. Null and empty texts stay as they are, an empty table stays
    empty, very long texts are searched whole, and further columns are carried along whatever their names.
    """
    queries.long_rows(spark)
    rows, _ = told_apart(carried(docs))
    cut = lpf_dedup.remove_repeats(rows, keep_first=True, whole_characters=True, words=PASSAGE_WORDS)
    text = F.when(F.col("text").isNotNull(), F.col("kept").cast("string"))
    out = restored(cut.withColumn("text", text), docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return out


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts hold none; equal texts stay or go together. Without documents, or without items, all
    rows stay. Very long texts are searched whole, and further columns are carried along whatever their names.
    """
    queries.long_rows(spark)
    return decontaminate.without_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, their number, and a digest of the text decoded from them.

    Null and empty texts have no ids; very long ones are encoded whole; repeated rows give repeated results, and
    an empty table an empty one. Further columns of the documents are not part of the result.
    """
    queries.long_rows(spark)
    coded = bpe.round_trip(docs, queries.WORDS, keep=("doc_id", "lang", "source"))
    return coded.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", encoding),
]

# Models, edit distances and suffix order are beyond SQL; the stages are tested against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_folder(spark, "pipeline")
    for place, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{folder}/{place}")
        docs = spark.read.parquet(f"{folder}/{place}")
    return docs
