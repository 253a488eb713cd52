"""The pipeline's stages, and the registered queries against their SQL."""

import re
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

import compare  # noqa: E402
import corpus_pipeline  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from mostrador.llm import decontaminate, lpf_dedup  # noqa: E402
from mostrador.llm.oracle import ORACLE  # noqa: E402
from mostrador.llm.queries import QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in compare.TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_its_sql(spark, db, name):
    verdict, _ = compare.compare(spark, db, SF_DIR, name)
    assert verdict.startswith("ok"), verdict


def test_every_operator_has_its_query():
    assert [re.match(r"op(\d+)_", n)[1] for n in QUERIES] == [str(n) for n in range(1, 14)]
    assert {*QUERIES, "pipeline"} <= set(queries()) and set(ORACLE) <= set(oracle_sql())
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents before and after each stage."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for place, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(f"{folder}/{place}")
        docs = spark.read.parquet(f"{folder}/{place}")
        out.append(docs)
    return out


def test_stages_keep_the_columns_and_take_effect(stages):
    for after in stages[1:-1]:
        assert after.columns == stages[0].columns and [t for _, t in after.dtypes] == [t for _, t in stages[0].dtypes]
    counts = [s.count() for s in stages]
    assert counts[0] > counts[1] > counts[2] == counts[3] > counts[4] == counts[5] > 0


def test_repeats_and_items_are_gone(spark, stages):
    texts = [r.text.encode() for r in stages[3].collect()]
    before = [r.text.encode() for r in stages[2].collect()]
    assert sum(map(len, texts)) < sum(map(len, before))
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    left = [decontaminate.folded(r.text) for r in stages[4].collect()]
    assert not any(decontaminate.folded(i.text) in t for i in items for t in left)
    gone = {r.doc_id for r in stages[3].collect()} - {r.doc_id for r in stages[4].collect()}
    hits = decontaminate.contaminated(stages[3], spark.read.parquet(f"{SF_DIR}/benchmark.parquet"))
    assert gone == {r.doc_id for r in hits.collect()}


def test_null_and_odd_rows_go_through(spark, stages):
    docs = stages[0].limit(5).unionByName(
        spark.createDataFrame([(None, None, None, None, None), (7, "", "en", "a", 0), (8, "hi", None, None, None)], stages[0].schema)
    )
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        assert out.count() <= docs.count(), name
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0, name


def test_a_passage_of_over_50_words_goes_however_short(spark, stages):
    words = [f"w{k:03d}x" for k in range(400)]
    passage = " ".join(words[:51])
    assert len(passage) < lpf_dedup.LENGTH
    texts = [f"{' '.join(words[100:130])} {passage} end", f"start {passage} {' '.join(words[200:230])}", " ".join(words[:50])]
    docs = spark.createDataFrame([(k, t, "en", "a", len(t)) for k, t in enumerate(texts)], stages[0].schema)
    found = {r.doc_id: r.text for r in corpus_pipeline.repeated_passages(spark, docs, SF_DIR).collect()}
    assert found == {0: texts[0], 1: texts[1].replace(passage, ""), 2: texts[2]}


def test_rows_that_share_an_id_or_have_none_are_decided_each_for_itself(spark, stages):
    a, b, c = (" ".join(f"{x}{k * k}" for k in range(60)) for x in "abc")
    rows = [(1, a), (2, a), (2, b), (3, c), (3, c), (None, c), (None, None), (-5, b), (4, None), (5, c + " more"), (5, b + " more")]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in rows], stages[0].schema).repartition(3)
    found = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, SF_DIR).collect()), key=str)
    assert found == sorted([(1, a), (-5, b), (3, c), (None, None), (4, None)], key=str)
    found = corpus_pipeline.repeated_passages(spark, docs.where("doc_id = 3 or doc_id is null"), SF_DIR).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in found) == [("3", ""), ("None", "None"), ("None", c)]


def test_a_clean_row_stays_when_its_id_is_shared(spark, stages):
    a, b = (" ".join(f"{x}{k * k}" for k in range(60)) for x in "ab")
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in [(1, a), (2, a), (2, b)]], stages[0].schema)
    found = {(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, SF_DIR).collect()}
    assert found == {(1, a), (2, b)}


@pytest.mark.parametrize("shared", [False, True])
def test_columns_named_as_the_stages_own_come_through(spark, stages, shared):
    words = [f"w{k:03d}x" for k in range(400)]
    passage = " ".join(words[:60])
    texts = [f"{' '.join(words[100:160])} {passage}", f"{passage} {' '.join(words[200:260])}", None, ""]
    names = ("row_key", "kept", "n_bytes", "spans", "id", "rid", "row", "candidate", "node", "n", "ids", "score", "h1", "a.b")
    docs = spark.createDataFrame([(1 if shared else k, t, "en", "a", len(t or "")) for k, t in enumerate(texts)], stages[0].schema)
    for name in names:
        docs = docs.withColumn(name, F.concat(F.lit(name), F.lit(" of "), F.coalesce("text", F.lit("nothing"))))
    told = ["text", *(f"`{n}`" for n in names)]
    before = {tuple(r) for r in docs.select(told).collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns, name
        found = [tuple(r) for r in out.select(told).collect()]
        assert {f[1:] for f in found} <= {b[1:] for b in before}, name
        if stage is corpus_pipeline.near_duplicates:
            assert set(found) == before and len(found) == 4
        if stage is corpus_pipeline.repeated_passages:
            assert len(found) == 4 and {f[0] for f in found} != {b[0] for b in before}
    assert corpus_pipeline.encoding(spark, docs, SF_DIR).count() == 4
