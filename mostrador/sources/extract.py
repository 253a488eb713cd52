"""Reading delimited sales extracts: checks, malformed rows, typed columns."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mostrador import schema as S
from mostrador.errors import EmptyInputError, MissingColumnsError, UnreadableInputError
from mostrador.functions import casting
from mostrador.session import PACKED, shared_folder

_CORRUPT = "_corrupt"
REJECTED = "_rechazo"
TOO_LONG = "_linea_larga"
_MARK = "\ufeff"


class Extract(NamedTuple):
    """One extract: typed rows, rows with values that do not fit, lines with too many fields."""

    rows: DataFrame
    rejected: DataFrame
    malformed: DataFrame


def input_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the non-empty input files; file contents are not read."""
    try:
        return spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    except AnalysisException as exc:
        raise EmptyInputError(f"input does not exist: '{path}'") from exc


def require_input(spark: SparkSession, path: str) -> None:
    if input_manifest(spark, path).isEmpty():
        raise EmptyInputError(f"input is empty (0 bytes): '{path}'")


def _options(spark: SparkSession, **more: str):
    reader = spark.read.option("sep", S.SEPARATOR).option("quote", S.QUOTE).option("escape", S.QUOTE)
    for key, value in more.items():
        reader = reader.option(key, value)
    return reader


def read_layout(spark: SparkSession, path: str) -> list[str]:
    """Column names in file order, from the first line of the extract."""
    names = _options(spark, header="true").csv(path).columns
    return [n.removeprefix(_MARK) for n in names]


def require_columns(found: Sequence[str], expected: Sequence[str] = S.RAW_COLUMNS) -> None:
    """Every expected column must be there; order and further columns are free."""
    missing = sorted(set(expected) - set(found))
    if missing:
        raise MissingColumnsError(
            f"required columns are missing: {missing}. Columns found: {sorted(set(found))}."
        )


def _split_header(line: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(line, f"^{_MARK}", ""), "[\"\r]", "")
    return F.split(bare, S.SEPARATOR)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, line, value): the lines of all input files that are not blank; ``line`` rises along a block."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    ).where(F.trim("value") != "")


def file_headers(lines: DataFrame) -> DataFrame:
    """(file, line, text, header): the first line of every input file, also as an array of names.

    ``lines`` are those of ``text_lines``. Only the block at the start of each file takes part,
    and each task keeps one line per file.
    """
    first = lines.where("block = 0").groupBy("file").agg(F.min_by(F.struct("line", "value"), "line").alias("first"))
    text = F.col("first.value")
    return first.select("file", F.col("first.line").alias("line"), text.alias("text"), _split_header(text).alias("header"))


def missing_columns(headers: DataFrame, expected: Sequence[str] = S.RAW_COLUMNS) -> DataFrame:
    """(file, missing): one row per required column a file lacks."""
    wanted = F.array(*[F.lit(c) for c in expected])
    return headers.select("file", F.explode(F.array_sort(F.array_except(wanted, "header"))).alias("missing"))


def schema_check(spark: SparkSession, path: str, expected: Sequence[str] = S.RAW_COLUMNS) -> DataFrame:
    """(file, missing): one row per required column a file lacks; no rows means it fits."""
    return missing_columns(file_headers(text_lines(spark, path)), expected)


def _undecodable_line(text: Column) -> Column:
    return ~F.is_valid_utf8(text) | F.contains(text, F.lit("\u0000"))


def require_headers(headers: DataFrame, path: str) -> None:
    """Every header is text, and names the required columns. Data lines are judged one by one, wherever they stand."""
    found = headers.agg(
        F.count_if(_undecodable_line(F.col("text"))).alias("unreadable"),
        F.count("*").alias("files"),
        F.first(
            F.when(F.size(F.array_except(F.array(*[F.lit(c) for c in S.RAW_COLUMNS]), "header")) > 0, F.col("header")), ignorenulls=True
        ).alias("lacking"),
    ).first()
    if found["unreadable"]:
        raise UnreadableInputError(f"'{path}' is not text in a valid encoding")
    if found["lacking"] is not None:
        require_columns(found["lacking"])
    if not found["files"]:
        raise UnreadableInputError(f"'{path}' was parsed but has no rows")


def staged_lines(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """All lines but headers, split into fields by the layout of their file; the input is read once, into ``folder``.

    Text columns, named as in the files, are the required ones and every further one that any file has; a file
    without it has NULLs there. ``TOO_LONG`` is the text of a line with more fields than its header, else NULL.
    """
    require_input(spark, path)
    text_lines(spark, path).write.mode("errorifexists").options(**PACKED).parquet(f"{folder}/lineas")
    lines = spark.read.parquet(f"{folder}/lineas")
    file_headers(lines).write.mode("errorifexists").parquet(f"{folder}/encabezados")
    headers = spark.read.parquet(f"{folder}/encabezados")
    require_headers(headers, path)
    # The names decide the columns of the result; their number does not grow with the data.
    names = [r["name"] for r in headers.select(F.explode("header").alias("name")).distinct().orderBy("name").collect()]
    names = [*S.RAW_COLUMNS, *[n for n in names if n not in S.RAW_COLUMNS and n]]
    width = headers.agg(F.max(F.size("header"))).first()[0]
    layout = headers.select(
        "file",
        F.col("line").alias("header_line"),
        F.size("header").alias("width"),
        F.transform(F.array(*[F.lit(n) for n in names]), lambda n: (F.array_position("header", n) - 1).cast("int")).alias("at"),
    )
    fields = [f"_{k}" for k in range(width)]
    schema = ", ".join(f"{f} string" for f in [*fields, _CORRUPT])
    options = {"sep": S.SEPARATOR, "quote": S.QUOTE, "escape": S.QUOTE, "mode": "PERMISSIVE", "columnPruning": "false", "columnNameOfCorruptRecord": _CORRUPT}
    placed = lines.join(layout, "file").where(F.col("line") != F.col("header_line"))
    # As a generator, so that no line is parsed once per field.
    parsed = placed.select("width", "at", "value", F.inline(F.array(F.from_csv("value", schema, options))))
    # Spark marks the lines that have not exactly as many fields as the widest header; only those are counted.
    unquoted = F.regexp_replace("value", f"{S.QUOTE}[^{S.QUOTE}]*{S.QUOTE}", "")
    number = F.when(F.col(_CORRUPT).isNull(), F.lit(width)).otherwise(F.size(F.split(unquoted, S.SEPARATOR)))
    long = F.when(number > F.col("width"), F.col("value"))
    listed = parsed.select("at", F.array(*fields).alias("fields"), long.alias(TOO_LONG))
    return listed.select(*[F.get("fields", F.get("at", F.lit(k))).alias(n) for k, n in enumerate(names)], TOO_LONG)


def _too_long(layout: Sequence[str]) -> Column:
    """More fields than the header has. Fewer are fine: the rest are NULL.

    Spark keeps the text of every row whose number of fields is not that of the
    header, so only those rows have their fields counted.
    """
    unquoted = F.regexp_replace(F.col(_CORRUPT), f"{S.QUOTE}[^{S.QUOTE}]*{S.QUOTE}", "")
    long = F.col(_CORRUPT).isNotNull() & (F.size(F.split(unquoted, S.SEPARATOR)) > len(layout))
    # Always true: Spark refuses to read the kept text without any column of the file.
    return long & (F.coalesce(F.col(f"`{layout[0]}`"), F.lit("")) >= "")


def read_rows(spark: SparkSession, path: str, layout: Sequence[str] | None = None) -> DataFrame:
    """All lines as text columns named as in the file, plus the text of lines of another length."""
    fields = [*(layout or read_layout(spark, path)), _CORRUPT]
    schema = T.StructType([T.StructField(name, T.StringType()) for name in fields])
    # Pruning columns would hide how many fields a row has.
    reader = _options(
        spark,
        header="true",
        mode="PERMISSIVE",
        columnPruning="false",
        columnNameOfCorruptRecord=_CORRUPT,
    )
    return reader.schema(schema).csv(path)


def _fields(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c != _CORRUPT]


def skip_malformed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with at most as many fields as the header, text of the longer ones)."""
    layout = _fields(rows)
    long = _too_long(layout)
    return rows.where(~long).select(*layout), rows.where(long).select(F.col(_CORRUPT).alias("linea"))


def malformed_counts(rows: DataFrame) -> DataFrame:
    """One row: lines kept and lines skipped for having too many fields, in one scan."""
    long = _too_long(_fields(rows))
    return rows.agg(F.count_if(~long).alias("kept"), F.count_if(long).alias("skipped"))


def rename_standard(rows: DataFrame) -> DataFrame:
    """Raw names to standard names; other columns keep theirs."""
    return rows.withColumnsRenamed(S.STANDARD_NAMES)


def _undecodable(text: Column) -> Column:
    return F.contains(text, F.lit("\ufffd")) | F.contains(text, F.lit("\u0000"))


def cast_columns(rows: DataFrame) -> DataFrame:
    """Text columns to the types of the data model, plus the list of columns that did not fit.

    A missing value is never a misfit, except the sale time, which is required.
    The birth date is coerced: what is no date becomes NULL. Text with bytes that
    cannot be decoded, or with NUL, is a misfit in any column and on any line.
    """
    converters = {
        S.SALE_TIME: casting.to_sale_time,
        S.BIRTH_DATE: casting.to_birth_date,
        **dict.fromkeys(S.INTEGER_COLUMNS, casting.to_integer),
        **dict.fromkeys(S.DECIMAL_COLUMNS, casting.to_decimal),
    }
    # Three steps, so that no text is cleaned and no value is converted twice.
    known = [c for c in rows.columns if c in S.STANDARD_COLUMNS]
    texts = rows.withColumns({c: casting.blank_to_null(F.col(c)) for c in known})
    converted = [c for c in known if c in converters]
    values = texts.withColumns({f"_{c}": converters[c](F.col(c)) for c in converted})
    misfits = [
        F.when(F.col(f"_{c}").isNull() & (F.col(c).isNotNull() | F.lit(c == S.SALE_TIME)), F.lit(c))
        for c in converted
        if c != S.BIRTH_DATE
    ]
    # Bytes that are no text arrive as the replacement character, wherever in the input they are.
    misfits += [F.when(_undecodable(F.col(c)), F.lit(c)) for c in known if c not in converted or c == S.BIRTH_DATE]
    return values.select(
        *[F.col(f"_{c}").alias(c) if c in converted else F.col(c) for c in rows.columns],
        F.array_compact(F.array(*misfits)).alias(REJECTED),
    )


def accepted(typed: DataFrame) -> DataFrame:
    return typed.where(F.size(REJECTED) == 0).drop(REJECTED)


def rejected(typed: DataFrame) -> DataFrame:
    return typed.where(F.size(REJECTED) > 0)


def require_no_rejects(typed: DataFrame) -> None:
    """Strict loading: a value that does not fit its column stops the load."""
    first = rejected(typed).select(REJECTED).first()
    if first is not None:
        raise UnreadableInputError(f"values do not fit columns {sorted(first[0])}")


def stage_extract(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """Renamed and typed rows with their misfit list and ``TOO_LONG``; files may order their columns differently.

    One layout or many, one file or many, bad bytes on the first line or the last: every line is treated alike.
    """
    return cast_columns(rename_standard(staged_lines(spark, path, folder)))


def typed_rows(spark: SparkSession, path: str) -> DataFrame:
    """Checked, renamed and typed rows with their misfit list, malformed lines skipped."""
    rows = stage_extract(spark, path, shared_folder(spark, "extracto")).where(F.col(TOO_LONG).isNull()).drop(TOO_LONG)
    if rows.select(S.SALE_TIME).isEmpty():
        raise UnreadableInputError(f"'{path}' was parsed but has no rows")
    return rows


def read_extract(spark: SparkSession, path: str) -> Extract:
    """Open an extract: its typed rows, the misfits, and the lines that are too long."""
    staged = stage_extract(spark, path, shared_folder(spark, "extracto"))
    typed = staged.where(F.col(TOO_LONG).isNull()).drop(TOO_LONG)
    malformed = staged.where(F.col(TOO_LONG).isNotNull()).select(F.col(TOO_LONG).alias("linea"))
    return Extract(accepted(typed), rejected(typed), malformed)


def read_mixed_extract(spark: SparkSession, path: str) -> DataFrame:
    """Typed rows of an extract in the required columns only, whatever further ones its files have."""
    return typed_rows(spark, path).select(*S.STANDARD_COLUMNS, REJECTED)
