"""The registered queries without SQL, run whole on the smallest given tables, against plain versions of their contracts."""

import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from mostrador.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts():
    rows = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{FOLDER}/documents.parquet' ORDER BY doc_id").fetchall()
    return dict(rows)


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _result(spark, name, columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in QUERIES[name](spark, FOLDER).collect()}


def test_ids_and_decoded_texts(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for doc, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids
        want[doc] = (len(ids), _sha(" ".join(map(str, ids))), _sha(library.decode(ids, skip_special_tokens=False)))
    assert _result(spark, "op1_bpe", ("n_tokens", "ids_sha256", "decoded_sha256")) == want


def test_edited_texts_and_equal_fingerprints(spark, texts):
    falling = sorted(texts, reverse=True)
    follows = dict(zip(falling, falling[1:] + falling[:1]))
    want = {}
    for doc, text in texts.items():
        half = len(text) // 2
        want[doc] = (len(text), _sha(text[: len(text) - half] + texts[follows[doc]][:half]))
    found = _result(spark, "op2_fingerprints", ("n_chars", "edited_sha256", "fingerprint", "near_next"))
    assert {doc: row[:2] for doc, row in found.items()} == want
    for doc, (*_, fingerprint, near) in found.items():
        assert 0 <= near <= 1
        if found[follows[doc]][2] == fingerprint:
            assert near == 1
    by_text = {}
    for doc, row in found.items():
        assert by_text.setdefault(texts[doc], row[2]) == row[2]


def test_token_counts(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    counts = {doc: len(library.encode(text, add_special_tokens=False).ids) for doc, text in texts.items()}
    want = {doc: (len(texts[doc].encode()), n, n > 512) for doc, n in counts.items()}
    assert _result(spark, "op4_token_counts", ("n_bytes", "n_tokens", "over_limit")) == want


def test_token_files(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, start = {}, 0
    for doc in sorted(texts):
        ids = [*library.encode(texts[doc], add_special_tokens=False).ids, 2]
        want[doc] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert _result(spark, "op9_token_files", ("start", "n_tokens", "ids_crc32")) == want


@pytest.mark.parametrize("name,cut", [("op5_toxicity", 0.5), ("op8_quality", 0.3)])
def test_scores_cover_every_row_and_keep_their_range(spark, texts, name, cut):
    found = _result(spark, name, ("held_out", "score", "predicted"))
    assert set(found) == set(texts)
    for doc, (held_out, score, predicted) in found.items():
        assert held_out == (zlib.crc32(str(doc).encode()) % 5 == 0)
        assert 0 <= score <= 1 and predicted == int(score >= cut)
