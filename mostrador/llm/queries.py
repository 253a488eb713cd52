"""The registered query of each operator, over its whole table and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mostrador.llm import (
    arc_warc,
    bpe,
    decontaminate,
    fingerprints,
    lpf_dedup,
    merkle,
    mixing,
    near_dup,
    orc_tokens,
    prefix_tokens,
    toxicity,
    whitening,
    zstd_quality,
)
from mostrador.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
TOKEN_LIMIT = 512


# Documents and pages are long rows; by default Spark hands Python 10,000 at a time.
ROWS_TO_PYTHON = 1_000


def long_rows(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_TO_PYTHON))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    long_rows(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return bpe.round_trip(docs, WORDS).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return fingerprints.edited_fingerprints(docs, fingerprints.fit_rarity(docs))


def op3_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "archives")
    arc_warc.write_arc(_table(spark, sf_dir, "pages"), f"{folder}/arc")
    records = arc_warc.read_arc(spark, f"{folder}/arc")
    digests = arc_warc.read_arc(spark, f"{folder}/arc", with_payload=False)
    arc_warc.write_warc(arc_warc.convert(records, digests=digests), f"{folder}/warc")
    records = arc_warc.read_warc(spark, f"{folder}/warc", with_payload=False)
    return arc_warc.referred_pages(records).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = prefix_tokens.prefix_table(_table(spark, sf_dir, "documents"), BYTES)
    return table.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def _held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "labels").where(~_held_out())


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, training_labels(spark, sf_dir))
    scored = docs.select("doc_id", _held_out().alias("held_out"), toxicity.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"), words=4, percent=80)


QUALITY_THRESHOLD = 0.3


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = zstd_quality.fit(docs, training_labels(spark, sf_dir))
    scored = docs.select("doc_id", _held_out().alias("held_out"), zstd_quality.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= QUALITY_THRESHOLD).cast("int"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "tokens")
    orc_tokens.write_tokens(_table(spark, sf_dir, "documents"), folder, WORDS)
    tokens = orc_tokens.read_tokens(spark, folder)
    return tokens.select("doc_id", "start", "n_tokens", orc_tokens.ids_crc32(F.col("ids")).alias("ids_crc32"))


def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lpf_dedup.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.components(whitening.quantised(_table(spark, sf_dir, "embeddings")))


def lower_cased() -> tuple[Column, dict[str, Column]]:
    """The tampering that op13 tries: every third document, by the checksum of its id, with A-Z in lower case."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    text = F.translate(F.col("text"), capitals, capitals.lower())
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 0, {"text": text}


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proof_digests(merkle.manifest(_table(spark, sf_dir, "documents"), tampered=lower_cased))


QUERIES: dict[str, Query] = {
    "op1_bpe": op1_bpe,
    "op2_fingerprints": op2_fingerprints,
    "op3_arc_to_warc": op3_arc_to_warc,
    "op4_token_counts": op4_token_counts,
    "op5_toxicity": op5_toxicity,
    "op6_decontamination": op6_decontamination,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_quality": op8_quality,
    "op9_token_files": op9_token_files,
    "op10_repeated_passages": op10_repeated_passages,
    "op11_mixing": op11_mixing,
    "op12_whitening": op12_whitening,
    "op13_merkle": op13_merkle,
}
