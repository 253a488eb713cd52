"""What the catalog stages of the given tables, and how often they are joined."""

import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from mostrador.catalog import tables
from mostrador.catalog.queries import QUERIES
from mostrador.functions import casting

SF = "/root/testdata/sf0.001"


def _files(folder):
    return [p for p in Path(folder.removeprefix("file://")).iterdir() if p.name.startswith("part-")]


@pytest.mark.parametrize("stage", [tables.csv_extract, tables.csv_extract_incomplete, tables.json_extract])
def test_staged_texts_are_packed_in_files_of_bounded_length(spark, stage, monkeypatch):
    monkeypatch.setitem(tables._PACKED, "maxRecordsPerFile", "1000")
    monkeypatch.setattr(tables, "_staged", {})
    files = _files(stage(spark, SF))
    assert all(p.name.endswith(".gz") for p in files)
    lines = [len(gzip.decompress(p.read_bytes()).splitlines()) for p in files]
    headers = 0 if stage is tables.json_extract else len(files)
    assert sum(lines) - headers == spark.read.parquet(f"{SF}/lineitem.parquet").count() and max(lines) <= 1001


def test_lengths_of_files_are_those_of_the_text(spark):
    assert not any(p.name.endswith(".gz") for p in _files(tables.csv_extract(spark, SF, packed=False)))


def test_the_value_of_an_integer_is_written_out_once(spark):
    plan = spark.createDataFrame([("1.0",)], "c string").select(casting.to_integer(F.col("c")))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("inf(inity)") <= 2  # once for the value, once for the name of the column


@pytest.mark.parametrize("name", ["apply_features", "engineer_features", "ingest_projection"])
def test_flows_that_read_their_sales_several_times_join_the_tables_once(spark, name):
    read = QUERIES[name](spark, SF).inputFiles()
    assert read and not any("lineitem.parquet" in f for f in read)
