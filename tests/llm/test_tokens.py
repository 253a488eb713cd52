"""Encoding, prefix counts and token files against the public tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from mostrador.llm import bpe, orc_tokens, prefix_tokens

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
LETTERS = [
    *"aAbe thE'srevmld  \n\t12!?.éÉñßΣσİǅ́  \x1c\x85漢字😀½²٣_-",
    "<|endoftext|>",
    "<|startoftext|>",
    "'re",
    "  ",
    "\n\n",
    "ing",
]
ODD = [None, "", " ", "\n\n \n", "x" * 3000, "ab " * 4000, "<|endoftext|>", "a<|endoftext|>b", "NUL\0inside", "same", "same"]


def _texts(n, seed=5):
    r = random.Random(seed)
    return ["".join(r.choice(LETTERS) for _ in range(r.randint(0, 25))) for _ in range(n)]


@pytest.fixture(scope="module")
def words():
    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def byte_level():
    return Tokenizer.from_file(BYTES)


def test_encoder_equals_the_library(words):
    encoder = bpe.WordEncoder(WORDS)
    texts = [*_texts(1500), *ODD]
    for text, found in zip(texts, encoder.encode_many(texts)):
        ids = np.frombuffer(found, "<i4").tolist()
        assert ids == words.encode(text or "", add_special_tokens=False).ids, repr(text)
        assert encoder.decode(ids) == words.decode(ids, skip_special_tokens=False)


def test_pieces_met_before_are_not_merged_again(words, monkeypatch):
    monkeypatch.setattr(bpe, "_CHARACTERS", 40, raising=False)  # several requests for one list of texts
    encoder, merged = bpe.WordEncoder(WORDS), []
    merge_all = encoder.table.merge_all
    monkeypatch.setattr(encoder.table, "merge_all", lambda pieces: merged.extend(pieces) or merge_all(pieces))
    texts = ["thaner ineros", "Thaner, ineros!! (thaner) 'tis don't, ...", "\u2003thaner\u3000ineros½!? 'sé\u00a0x-y_", "<|endoftext|>!! thaner's", None, " "] * 2
    for text in texts:
        ids = np.frombuffer(encoder.encode_many([text])[0], "<i4").tolist()
        assert ids == words.encode(text or "", add_special_tokens=False).ids, repr(text)
    assert len(merged) == len(set(merged))
    assert encoder.encode_many(texts) == [encoder.encode_many([text])[0] for text in texts]


def test_one_tree_and_many_trees_in_step_agree():
    table = bpe.MergeTable(WORDS)
    r = random.Random(3)
    pieces = ["".join(r.choice("thineragosé") for _ in range(r.randint(1, 70))).encode() for _ in range(600)]
    alone = [np.array(table.merge(table.symbols(p)), "<i4").tobytes() for p in pieces]
    assert table.merge_all(pieces) == alone


def test_ids_and_decoded_text_of_a_table(frame, words):
    docs = frame([(i, t) for i, t in enumerate(ODD)] + [(None, "no id")], "doc_id bigint, text string")
    rows = bpe.round_trip(docs, WORDS).collect()
    assert len(rows) == len(ODD) + 1
    for row in rows:
        text = "no id" if row.doc_id is None else ODD[row.doc_id] or ""
        assert list(row.ids) == words.encode(text, add_special_tokens=False).ids
        assert row.decoded == words.decode(list(row.ids), skip_special_tokens=False)
    columns = docs.select("doc_id", bpe.encode(docs["text"], WORDS).alias("ids")).select("ids", bpe.decode("ids", WORDS).alias("d"))
    assert sorted(r.d for r in columns.collect()) == sorted(r.decoded for r in rows)
    assert bpe.round_trip(docs.limit(0), WORDS).count() == 0


def test_every_prefix_has_its_exact_count(byte_level):
    counter = prefix_tokens.PrefixCounter(BYTES)
    texts = _texts(150, 8) + ["I'll we're 'r 'l", "a  b\n\n\nc \n d", "naïve 漢字 text", "x<|endoftext|>\n\ny"]
    for text, changes in zip(texts, counter.changes_many(texts)):
        counts = np.cumsum(np.frombuffer(changes, np.int8)).tolist()
        assert counts == [len(byte_level.encode(text[: i + 1], add_special_tokens=False).ids) for i in range(len(text))], repr(text)


def test_questions_answered_from_the_table(frame, byte_level):
    text = "The thing about tokens: they don't always grow with the text."
    docs = frame([(1, text, "x"), (2, None, "y"), (2, "", "z")], "doc_id bigint, text string, changes string")
    table = prefix_tokens.prefix_table(docs, BYTES)
    rows = sorted(table.collect(), key=lambda r: (r.doc_id, r.n_tokens))
    assert [(r.doc_id, r.n_bytes, r.n_tokens) for r in rows] == [(1, len(text), len(byte_level.encode(text).ids)), (2, 0, 0), (2, 0, 0)]
    from pyspark.sql import functions as F

    asked = table.where("doc_id = 1").select(
        prefix_tokens.tokens_before(F.col("changes"), F.lit(9)).alias("before"),
        prefix_tokens.chars_within(F.col("changes"), F.lit(4)).alias("within"),
    ).first()
    assert asked.before == len(byte_level.encode(text[:9]).ids)
    fitting = [n for n in range(len(text) + 1) if len(byte_level.encode(text[:n]).ids) <= 4]
    assert asked.within == max(fitting)


def test_token_files_round_trip(spark, frame, folder, words):
    rows = [(i * 3, t) for i, t in enumerate(ODD)] + [(None, "first")]
    orc_tokens.write_tokens(frame(rows, "doc_id bigint, text string"), folder("tokens"), WORDS)
    read = orc_tokens.read_tokens(spark, folder("tokens"))
    found = read.withColumn("crc", orc_tokens.ids_crc32(read["ids"])).collect()
    found.sort(key=lambda r: (r.doc_id is not None, r.doc_id))
    start = 0
    for row, (_, text) in zip(found, sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)), strict=True):
        ids = [*words.encode(text or "", add_special_tokens=False).ids, orc_tokens.END_ID]
        assert (list(row.ids), row.start, row.n_tokens) == (ids, start, len(ids))
        assert row.crc == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_files_rise_by_id_and_prune_by_it(spark, frame, folder):
    docs = frame([(i, f"text {i}") for i in range(500)], "doc_id bigint, text string")
    orc_tokens.write_tokens(docs, folder("tokens"), WORDS)
    data = spark.read.orc(f"{folder('tokens')}/data")
    ranges = data.groupBy("part").agg({"doc_id": "min"}).orderBy("part").collect()
    assert [r[1] for r in ranges] == sorted(r[1] for r in ranges) and len(ranges) > 1
    plan = orc_tokens.read_tokens(spark, folder("tokens")).where("doc_id = 77")._jdf.queryExecution().toString()
    assert "EqualTo(doc_id,77)" in plan


def test_empty_table_gives_no_tokens(spark, frame, folder):
    orc_tokens.write_tokens(frame([], "doc_id bigint, text string"), folder("none"), WORDS)
    assert orc_tokens.read_tokens(spark, folder("none")).count() == 0
