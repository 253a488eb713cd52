"""Legacy web archives (ARC) and their conversion to WARC.

``write_arc`` makes ARC files of a table of pages, ``read_arc`` parses ARC files of
version 1 and 2, ``convert`` gives their records WARC identifiers, times, types and
digests and refers equal payloads to one response, ``write_warc`` and ``read_warc``
store and load the result. All files go through Spark's text source, so they may lie
in any store Spark reads. They are compressed, hence not split; a task streams whole
files and holds one record at a time. Record bodies are taken by their declared
length, whatever bytes they hold.

Edge cases: a null payload is empty, a null address becomes ``urn:page:<id>`` and a
null id stays null. White space in addresses is percent-encoded. A record that ends
before its declared length keeps the bytes there are and is marked truncated; a line
where a header should stand and none can be read is returned with its text in
``error`` and is not converted. Rows with equal ids are all kept; of equal payloads,
every row with the largest id is a response. An empty table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the two formats.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
WARC_VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BLANK = "\r\n\r\n"
_ROW_BITS = 33  # monotonically_increasing_id numbers the rows of a partition in so many bits

ARC_DATE = "20240101000000"
ARC_ADDRESS = "0.0.0.0"
_BATCH_BYTES = 16 << 20


def _first_row() -> Column:
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) == 0


def _text(value: str) -> Column:
    return F.lit(value)


def write_arc(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", date: str = ARC_DATE
) -> None:
    """One ARC file per partition, of version 1 and 2 in turn; each begins with its ``filedesc`` record."""
    rows = pages.select(
        F.col(page_id).cast("string").alias("id"),
        F.coalesce(F.regexp_replace(url, r"\s", "%20"), F.concat(_text("urn:page:"), F.coalesce(F.col(page_id).cast("string"), _text("none")))).alias("url"),
        F.coalesce(F.col(html), _text("")).alias("html"),
    )
    identity = F.coalesce(F.concat(_text("X-Page-Id: "), F.col("id"), _text("\r\n")), _text(""))
    block = F.concat(
        _text("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"),
        identity,
        _text("Content-Length: "),
        F.octet_length("html").cast("string"),
        _text(_BLANK),
        F.col("html"),
    )
    rows = rows.select("id", "url", block.alias("block"), (F.spark_partition_id() % 2 + 1).alias("version"), _first_row().alias("first"))
    length = F.octet_length("block").cast("string")
    common = [F.col("url"), _text(ARC_ADDRESS), _text(date), _text("text/html")]
    header = F.when(F.col("version") == 1, F.concat_ws(" ", *common, length)).otherwise(
        F.concat_ws(" ", *common, _text("200"), _text("-"), _text("-"), _text("0"), _text("pages.arc"), length)
    )

    def opening(version: int) -> str:
        body = f"{version} 0 pages\n{ARC_FIELDS[version]}\n"
        line = f"filedesc://pages.arc {ARC_ADDRESS} {date} text/plain"
        line += f" {len(body)}" if version == 1 else f" 200 - - 0 pages.arc {len(body)}"
        return f"{line}\n{body}\n"

    start = F.when(~F.col("first"), _text("")).when(F.col("version") == 1, _text(opening(1))).otherwise(_text(opening(2)))
    (
        rows.select(F.concat(start, header, _text("\n"), F.col("block")).alias("value"))
        .write.mode("overwrite")
        .options(**{"compression": "gzip", "lineSep": "\n", "maxRecordsPerFile": "0", "zlib.compress.level": "BEST_SPEED"})
        .text(folder)
    )


def _segments(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())


class _Reader:
    """Puts segments of a file together to bodies of a declared length."""

    def __init__(self, segments: Iterator[tuple[str, bytes]], separator: bytes) -> None:
        self._segments, self._separator = segments, separator
        self._held: tuple[str, bytes] | None = None

    def next(self) -> tuple[str, bytes] | None:
        if self._held is not None:
            found, self._held = self._held, None
            return found
        return next(self._segments, None)

    def body(self, file: str, length: int) -> tuple[bytes, bool]:
        """The next ``length`` bytes of the file, and whether they were all there."""
        parts: list[bytes] = []
        size = -len(self._separator)
        while size < length:
            found = self.next()
            if found is None or found[0] != file:
                self._held = found
                break
            parts.append(found[1])
            size += len(found[1]) + len(self._separator)
        joined = self._separator.join(parts)
        if len(joined) > length and parts:
            # The body ended inside a segment: the rest of it begins the next record.
            rest = joined[length:].lstrip(b"\r\n")
            if rest:
                self._held = (file, rest)
        return joined[:length], len(joined) >= length


def arc_records(segments: Iterator[tuple[str, bytes]]) -> Iterator[dict]:
    """The records of ARC files, given as (file, line); ``filedesc`` records set the version of what follows."""
    reader, file, fields, opened = _Reader(segments, b"\n"), None, None, None
    while (found := reader.next()) is not None:
        if found[0] != file:
            file, fields, opened = found[0], None, None
        line = found[1].rstrip(b"\r")
        if not line:
            continue
        parts = line.decode("utf-8", "replace").split(" ")
        by_count = {len(names.split(" ")): names.split(" ") for names in ARC_FIELDS.values()}
        names = fields if fields and len(fields) == len(parts) else by_count.get(len(parts))
        if names is None or not re.fullmatch(r"\d{1,18}", parts[-1], re.ASCII) or not re.fullmatch(r"\d{8,14}", parts[2], re.ASCII):
            yield {"error": line.decode("utf-8", "replace")}
            continue
        header = dict(zip(names, parts))
        body, whole = reader.body(file, int(header["Archive-length"]))
        if header["URL"].startswith("filedesc:"):
            named = body.decode("utf-8", "replace").split("\n")
            version = named[0].split(" ")[0] if named else ""
            fields = ARC_FIELDS.get(int(version) if version in ("1", "2") else 1, "").split(" ")
            opened = header["Archive-date"]
            continue
        yield {
            "target_uri": header["URL"],
            "ip": header["IP-address"],
            "date": header["Archive-date"] if len(header["Archive-date"]) == 14 else opened or header["Archive-date"].ljust(14, "0"),
            "content_type": header["Content-type"],
            "block": body,
            "truncated": not whole,
        }


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _head_and_payload(block: bytes) -> tuple[bytes, bytes]:
    """An HTTP message's head, with its blank line, and its payload; other blocks are all payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    head, blank, payload = block.partition(_BLANK.encode())
    return head + blank, payload


def _head_value(head: bytes, name: bytes) -> bytes | None:
    found = re.search(rb"\r\n" + re.escape(name) + rb":[ \t]*([^\r\n]*)", head, re.IGNORECASE)
    return found[1] if found else None


def _identity(head: bytes) -> int | None:
    value = _head_value(head, b"X-Page-Id")
    return int(value) if value and re.fullmatch(rb"-?\d{1,19}", value) else None


def _batched(rows: Iterable[dict], schema: pa.Schema, weight: str) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 200 + len(row.get(weight) or b"")
        if size >= _BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


_RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("target_uri", pa.string()),
        ("ip", pa.string()),
        ("record_id", pa.string()),
        ("warc_date", pa.string()),
        ("kind", pa.string()),
        ("head", pa.binary()),
        ("payload", pa.binary()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("block_digest", pa.string()),
        ("head_digest", pa.string()),
        ("truncated", pa.bool_()),
        ("error", pa.string()),
    ]
)
_RECORD_SQL = (
    "page_id bigint, target_uri string, ip string, record_id string, warc_date string, kind string, head binary, "
    "payload binary, payload_bytes bigint, payload_digest string, block_digest string, head_digest string, "
    "truncated boolean, error string"
)


def _as_warc(record: dict) -> dict:
    """Identifier, time, type and digests that WARC asks for, from an ARC record alone, so a retry gives the same."""
    if "error" in record:
        return record
    block, stamp = record["block"], record["date"]
    head, payload = _head_and_payload(block)
    block_digest = base32_sha1(block)
    name = f"{record['target_uri']} {stamp} {block_digest}"
    return {
        "page_id": _identity(head),
        "target_uri": record["target_uri"],
        "ip": record["ip"],
        "record_id": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>",
        "warc_date": f"{stamp[:4]}-{stamp[4:6]}-{stamp[6:8]}T{stamp[8:10]}:{stamp[10:12]}:{stamp[12:14]}Z",
        "kind": "response" if head else "resource",
        "head": head,
        "payload": payload,
        "payload_bytes": len(payload),
        "payload_digest": base32_sha1(payload),
        "block_digest": block_digest,
        "head_digest": base32_sha1(head),
        "truncated": record["truncated"],
    }


def _segment_rows(spark: SparkSession, folder: str, separator: str) -> DataFrame:
    read = spark.read.option("lineSep", separator).text(folder)
    return read.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))


def read_arc(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of all ARC files of a folder, with what WARC needs of them; without bodies where only their digests matter."""
    bare = {} if with_payload else {"head": None, "payload": None}

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = (_as_warc(r) | bare for r in arc_records(_segments(batches)))
        yield from _batched(records, _RECORD, "payload")

    return _segment_rows(spark, folder, "\n").mapInArrow(parsed, _RECORD_SQL)


def convert(records: DataFrame, least_bytes: int = 0, digests: DataFrame | None = None) -> DataFrame:
    """Type of each record: of equal payloads of ``least_bytes`` or more, the one with the largest page id is
    the response and the others revisit it; smaller payloads are responses each.

    Payloads are equal when digest and length are. The winner of each digest is found by a
    combined aggregate of small rows; the join that hands it out may split a hot digest.
    ``digests`` may give the same records without their bodies, to make that aggregate cheaper.
    """
    known = records.where(F.col("error").isNull())
    best = (
        (known if digests is None else digests.where(F.col("error").isNull())).where((F.col("payload_bytes") >= least_bytes) & F.col("page_id").isNotNull())
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.max(F.struct("page_id", "record_id", "target_uri", "warc_date")).alias("best"))
    )
    joined = known.join(best, ["payload_digest", "payload_bytes"], "left")
    again = F.col("best").isNotNull() & ~F.col("best.page_id").eqNullSafe(F.col("page_id"))
    return joined.withColumns(
        {
            "record_type": F.when(again, F.lit("revisit")).otherwise(F.col("kind")),
            "refers_to_id": F.when(again, F.col("best.record_id")),
            "refers_to_uri": F.when(again, F.col("best.target_uri")),
            "refers_to_date": F.when(again, F.col("best.warc_date")),
        }
    )


def write_warc(records: DataFrame, folder: str) -> None:
    """One WARC file per task, each with its ``warcinfo`` record first. Revisits keep the HTTP head only."""

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(_text(f"{name}: "), value, _text("\r\n")), _text(""))

    again = F.col("record_type") == "revisit"
    block = F.when(again, F.col("head")).otherwise(F.concat("head", "payload"))
    info = "software: mostrador\r\nformat: WARC File Format 1.1\r\n"
    opening = (
        f"{WARC_VERSION}\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, folder)}>\r\n"
        f"WARC-Date: 2024-01-01T00:00:00Z\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}{_BLANK}{info}{_BLANK}"
    )
    header = F.concat(
        F.when(_first_row(), _text(opening)).otherwise(_text("")),
        _text(f"{WARC_VERSION}\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", F.col("warc_date")),
        line("WARC-Target-URI", F.col("target_uri")),
        line("WARC-IP-Address", F.col("ip")),
        line("WARC-Payload-Digest", F.concat(_text("sha1:"), F.col("payload_digest"))),
        line("WARC-Block-Digest", F.concat(_text("sha1:"), F.when(again, F.col("head_digest")).otherwise(F.col("block_digest")))),
        F.when(F.col("truncated"), _text("WARC-Truncated: length\r\n")).otherwise(_text("")),
        line("WARC-Refers-To", F.col("refers_to_id")),
        line("WARC-Refers-To-Target-URI", F.col("refers_to_uri")),
        line("WARC-Refers-To-Date", F.col("refers_to_date")),
        F.when(again, _text(f"WARC-Profile: {REVISIT_PROFILE}\r\n")).otherwise(_text("")),
        F.when(F.length("head") > 0, _text("Content-Type: application/http; msgtype=response\r\n")).otherwise(_text("")),
        _text("Content-Length: "),
        F.length(block).cast("string"),
        _text(_BLANK),
    )
    (
        records.select(F.concat(header.cast("binary"), block).cast("string").alias("value"))
        .write.mode("overwrite")
        .options(**{"compression": "gzip", "lineSep": _BLANK, "maxRecordsPerFile": "0", "zlib.compress.level": "BEST_SPEED"})
        .text(folder)
    )


def warc_records(segments: Iterator[tuple[str, bytes]]) -> Iterator[dict]:
    """The records of WARC files, given as (file, segment between blank lines)."""
    reader = _Reader(segments, _BLANK.encode())
    while (found := reader.next()) is not None:
        file, head = found
        head = head.lstrip(b"\r\n")
        if not head:
            continue
        lines = head.decode("utf-8", "replace").split("\r\n")
        named = dict(x.partition(":")[::2] for x in lines[1:])
        fields = {name.strip().lower(): value.strip() for name, value in named.items()}
        if not lines[0].startswith("WARC/") or not re.fullmatch(r"\d{1,18}", fields.get("content-length", ""), re.ASCII):
            yield {"error": lines[0]}
            continue
        block, whole = reader.body(file, int(fields["content-length"]))
        yield {"fields": fields, "block": block, "truncated": not whole or "warc-truncated" in fields}


_READ = pa.schema(
    [
        ("page_id", pa.int64()),
        ("record_type", pa.string()),
        ("record_id", pa.string()),
        ("refers_to_id", pa.string()),
        ("target_uri", pa.string()),
        ("warc_date", pa.string()),
        ("payload", pa.binary()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("intact", pa.bool_()),
        ("error", pa.string()),
    ]
)
_READ_SQL = (
    "page_id bigint, record_type string, record_id string, refers_to_id string, target_uri string, warc_date string, "
    "payload binary, payload_bytes bigint, payload_digest string, intact boolean, error string"
)


def _as_read(record: dict, with_payload: bool) -> dict:
    if "error" in record:
        return record
    fields, (head, payload) = record["fields"], _head_and_payload(record["block"])
    again = fields.get("warc-type") == "revisit"
    declared = _head_value(head, b"Content-Length")
    own = base32_sha1(payload)
    named = fields.get("warc-payload-digest", "").removeprefix("sha1:") or own
    block_digest = fields.get("warc-block-digest", "").removeprefix("sha1:")
    return {
        "page_id": _identity(head),
        "record_type": fields.get("warc-type"),
        "record_id": fields.get("warc-record-id"),
        "refers_to_id": fields.get("warc-refers-to"),
        "target_uri": fields.get("warc-target-uri"),
        "warc_date": fields.get("warc-date"),
        "payload": payload if with_payload else None,
        "payload_bytes": int(declared) if again and declared and declared.isdigit() else len(payload),
        "payload_digest": named,
        "intact": not record["truncated"] and (again or named == own) and block_digest in ("", base32_sha1(record["block"])),
    }


def read_warc(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """All records of a folder's WARC files but ``warcinfo``; ``intact`` tells whether lengths and digests hold."""

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = (_as_read(r, with_payload) for r in warc_records(_segments(batches)))
        yield from _batched((r for r in read if r.get("record_type") != "warcinfo"), _READ, "payload")

    return _segment_rows(spark, folder, _BLANK).mapInArrow(parsed, _READ_SQL)


def referred_pages(records: DataFrame) -> DataFrame:
    """``refers_to``: the page id of the response that a revisit names, found by its record id."""
    responses = records.where((F.col("record_type") != "revisit") & F.col("page_id").isNotNull())
    named = responses.groupBy(F.col("record_id").alias("refers_to_id")).agg(F.max("page_id").alias("refers_to"))
    return records.join(named, "refers_to_id", "left")
