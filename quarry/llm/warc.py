"""WARC archives: Spark's text writer for records, a Python data source for reading.

Writing is one pass of column expressions through Spark's own text writer (a
record is a line that ends in two CRLFs), so archives go to any file system
that Spark writes to and follow its commit protocol. Reading plans files into
partitions by size, tests record-type and header predicates on the parsed
headers, and seeks over the payloads that nobody asked for.
"""

from __future__ import annotations

import gzip
import io
import os
from collections.abc import Callable, Iterator, Sequence
from typing import Any, BinaryIO
from urllib.parse import urlparse

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
)

from quarry.llm.tables import cut

SPLIT_BYTES = 64 << 20          # files are packed into partitions of about this size
BATCH_BYTES = 8 << 20           # payload bytes in one Arrow batch
RECORDS_PER_FILE = 20_000
CRLF = "\r\n"
# fixed values of the format
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADER_OF = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri",
             "date": "warc-date", "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to",
             "content_type": "content-type", "content_length": "content-length"}
SCHEMA = ("record_type string, record_id string, target_uri string, date string, payload_digest string, "
          "refers_to string, content_type string, content_length bigint, http_status int, "
          "payload_bytes bigint, payload binary, damaged boolean")


def sha1_base32(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary column: 20 bytes are 32 digits of 5 bits."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def _one_line(c: Column) -> Column:
    """A header value cannot hold line ends."""
    return F.regexp_replace(c, r"[\r\n]", " ")


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
            date: str = "1970-01-01T00:00:00Z", revisit_bytes: int = 0) -> DataFrame:
    """One WARC record per row, as ``(record)`` without its closing CRLFs.

    Of rows with equal payloads of at least ``revisit_bytes`` bytes the one with
    the largest id is a ``response``; the others are ``revisit`` records that
    refer to it and carry the response's HTTP head but no payload. Smaller
    payloads are all responses. A null payload is empty, a null url leaves the
    header out, a null id is written as an empty one and is a response only if
    its group has no other id; rows that repeat the largest id are all
    responses. Payloads are not shuffled unless the table of repeated digests
    is too large to broadcast. Runs a job.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    data = F.encode("payload", "UTF-8")
    rows = rows.withColumn("digest", sha1_base32(data)).withColumn("n", F.octet_length(data).cast("long"))
    repeated = cut(rows.where(F.col("n") >= revisit_bytes).groupBy("digest")
                   .agg(F.max("id").alias("first_id"), F.count(F.lit(1)).alias("rows"))
                   .where("rows > 1 and first_id is not null").select(F.col("digest").alias("d"), "first_id"), "warc-repeats")
    rows = rows.join(repeated, F.col("digest") == F.col("d"), "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("n").cast("string"), F.lit(CRLF * 2))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(_one_line(c.cast("string")), F.lit("")), F.lit(">"))
    head = F.concat_ws(
        CRLF,
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), urn(F.col("id"))),
        F.concat(F.lit("WARC-Target-URI: "), _one_line(F.col("url"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {REVISIT_PROFILE}{CRLF}WARC-Refers-To: "), urn(F.col("first_id")))),
        F.lit("Content-Type: application/http;msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(F.encode(block, "UTF-8")).cast("string")))
    return rows.select(F.concat(head, F.lit(CRLF * 2), block).alias("record"))


def write(recs: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write records as archives (uncompressed, so that a reader can seek over payloads)."""
    (recs.write.option("lineSep", CRLF * 2).option("maxRecordsPerFile", records_per_file)
     .mode("error").text(path))


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """Local paths and file: URIs, or any URI that Arrow can open."""
    uri = urlparse(path)
    if uri.scheme in ("", "file"):
        return pafs.LocalFileSystem(), uri.path
    return pafs.FileSystem.from_uri(path)


class WarcPartition(InputPartition):
    def __init__(self, files: list[str]):
        self.files = files


class WarcDataSource(DataSource):
    """``spark.read.format("warc").load(path)``; option ``payload`` (default true): decode payloads or not.

    Files of any folder depth are read, ``.gz`` ones as streams of members;
    names that start with ``_`` or ``.`` are left out. One file is one task's,
    so writers should roll files (``records_per_file``).
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: Any) -> DataSourceReader:
        return WarcReader(self.options)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.payload = str(options.get("payload", "true")).lower() == "true"
        self.mark = str(options.get("damaged", "fail")).lower() == "mark"
        self.split_bytes = int(options.get("split_bytes", SPLIT_BYTES))
        self.tests: list[tuple[str, Callable[[Any], bool]]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802 - Spark's name
        """Keep what headers can answer; hand the rest back to Spark."""
        for f in filters:
            test = _header_test(f)
            if test is None:
                yield f
            else:
                self.tests.append(test)

    def partitions(self) -> Sequence[InputPartition]:
        fs, root = _file_system(self.path)
        found = fs.get_file_info(pafs.FileSelector(root, recursive=True))
        files = [(i.path, i.size) for i in found if i.type == pafs.FileType.File and i.size
                 and not os.path.relpath(i.path, root).startswith(("_", ".")) and "/_" not in os.path.relpath(i.path, root)
                 and not os.path.basename(i.path).startswith(("_", "."))]
        parts: list[InputPartition] = []
        group, size = [], 0
        for path, n in sorted(files):
            if group and size + n > self.split_bytes:
                parts.append(WarcPartition(group))
                group, size = [], 0
            group.append(path)
            size += n
        if group or not parts:
            parts.append(WarcPartition(group))
        return parts

    def read(self, partition: WarcPartition) -> Iterator[pa.RecordBatch]:
        fs, _ = _file_system(self.path)
        rows: list[tuple] = []
        size = 0
        for path in partition.files:
            raw = open(path, "rb") if isinstance(fs, pafs.LocalFileSystem) else io.BufferedReader(fs.open_input_file(path))
            with raw, (gzip.open(raw, "rb") if path.endswith(".gz") else raw) as f:
                for row in scan(f, self.tests, self.payload, self.mark):
                    rows.append(row)
                    size += len(row[-2] or b"") + 200
                    if size >= BATCH_BYTES:
                        yield _batch(rows)
                        rows, size = [], 0
        if rows:
            yield _batch(rows)


_ARROW = pa.schema([("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()),
                    ("date", pa.string()), ("payload_digest", pa.string()), ("refers_to", pa.string()),
                    ("content_type", pa.string()), ("content_length", pa.int64()), ("http_status", pa.int32()),
                    ("payload_bytes", pa.int64()), ("payload", pa.binary()), ("damaged", pa.bool_())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


_COMPARE: dict[type, Callable[[Any, Any], bool]] = {
    EqualTo: lambda v, x: v == x, In: lambda v, x: v in x,
    GreaterThan: lambda v, x: v > x, GreaterThanOrEqual: lambda v, x: v >= x,
    LessThan: lambda v, x: v < x, LessThanOrEqual: lambda v, x: v <= x,
    StringStartsWith: lambda v, x: v.startswith(x), StringEndsWith: lambda v, x: v.endswith(x),
    StringContains: lambda v, x: x in v,
}


def _header_test(f: Filter) -> tuple[str, Callable[[Any], bool]] | None:
    """``(column, test of its value)`` if headers alone answer the filter."""
    if isinstance(f, Not):
        inner = f.child
        test = _header_test(inner)
        if test is None or isinstance(inner, (IsNull, IsNotNull)):
            return None
        column, holds = test
        return column, lambda v: v is not None and not holds(v)
    column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
    if column not in HEADER_OF:
        return None
    if isinstance(f, IsNotNull):
        return column, lambda v: v is not None
    if isinstance(f, IsNull):
        return column, lambda v: v is None
    compare = _COMPARE.get(type(f))
    if compare is None:
        return None
    x = f.value
    return column, lambda v: v is not None and compare(v, x)


def _headers(f: BinaryIO, limit: int | None = None) -> tuple[dict[str, str], int]:
    """Headers (names lower-cased) and the bytes read, up to and with the blank line; at most ``limit`` bytes."""
    n, headers, name = 0, {}, ""
    while limit is None or n < limit:
        line = f.readline() if limit is None else f.readline(limit - n)
        n += len(line)
        if not line.rstrip(b"\r\n"):
            break
        value = line.strip().decode("utf-8", "replace")
        if line[:1] in b" \t" and name:                # folded
            headers[name] += " " + value
            continue
        name, _, value = value.partition(":")
        name = name.strip().lower()
        headers[name] = value.strip()
    return headers, n


class Damaged(ValueError):
    """An archive that ends inside a record, or a record whose length cannot be read."""


def scan(f: BinaryIO, tests: list[tuple[str, Callable[[Any], bool]]], payload: bool, mark: bool = False) -> Iterator[tuple]:
    """Rows of the records that pass the header tests.

    What is read or skipped is held against the declared length. A record that
    is cut short, or has a length that is no number, raises ``Damaged``; with
    ``mark`` it comes as a row with ``damaged`` true and the bytes there are,
    whatever the tests say, and ends its file, as nothing tells where a next
    record would begin.
    """

    def skip(n: int) -> int:
        """Bytes of the n that are there."""
        if n:
            at = f.tell()
            f.seek(n - 1, io.SEEK_CUR)
            if not f.readline(1):
                f.seek(at)
                return len(f.read(n))
        return n

    while True:
        start = f.readline()
        while start in (b"\r\n", b"\n"):
            start = f.readline()
        if not start:
            return
        if not start.startswith(b"WARC/"):
            raise Damaged(f"no WARC record at {start[:40]!r}")
        headers, _ = _headers(f)
        declared = headers.get("content-length", "0")
        values: dict[str, Any] = {c: headers.get(h) for c, h in HEADER_OF.items()}
        names = [values[c] for c in list(HEADER_OF)[:6]]
        if not (declared.isascii() and declared.isdigit()):
            if not mark:
                raise Damaged(f"record {values['record_id']} has the length {declared!r}")
            yield (*names, values["content_type"], None, None, None, None, True)
            return
        length = int(declared)
        values["content_length"] = length
        wanted = all(test(values[c]) for c, test in tests)
        status, size, data, there = None, length, None, 0
        try:
            if wanted and (values["content_type"] or "").startswith("application/http"):
                first = f.readline(length)
                http, read = _headers(f, length - len(first))
                words = first.split()
                status = int(words[1]) if len(words) > 1 and words[1].isdigit() else None
                there = len(first) + read
                size = length - there
            if wanted and payload and values["record_type"] != "revisit":
                data = f.read(size)
                there += len(data)
            else:
                there += skip(length - there)
        except EOFError:                                    # a compressed archive that ends inside its stream
            there = min(there, length - 1)
        if there < length:
            if not mark:
                raise Damaged(f"record {values['record_id']} ends after {there} of {length} bytes")
            yield (*names, values["content_type"], length, status, max(0, size - (length - there)), data, True)
            return
        if not wanted:
            continue
        if values["record_type"] == "revisit" and (values["content_type"] or "").startswith("application/http"):
            # the payload is the earlier record's; its head tells the size
            told = http.get("content-length", "")
            size = int(told) if told.isdigit() else None
        yield (*names, values["content_type"], length, status, size, data, False)


def read(spark: SparkSession, path: str, payload: bool = True, damaged: str = "fail") -> DataFrame:
    """The records under ``path``; filters on header columns reach the reader.

    ``damaged``: an archive that ends inside a record, or a record without a
    readable length, fails the job (``fail``), or is a row with the column
    ``damaged`` true, the last of its file (``mark``). A folder without archives
    gives no rows.

    Spark keeps pushed filters with the loaded relation, so load anew for
    every set of filters.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).option("damaged", damaged).load(path)
