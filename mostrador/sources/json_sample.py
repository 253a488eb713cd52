"""Reading sales as a JSON array of objects with the raw column names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from mostrador import schema as S
from mostrador.sources.extract import cast_columns, rename_standard


def read_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Typed rows with their misfit list.

    ``multi_line`` reads whole documents (one array per file); without it every
    line is an object, which lets Spark split large files.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in S.RAW_COLUMNS])
    rows = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    return cast_columns(rename_standard(rows))
