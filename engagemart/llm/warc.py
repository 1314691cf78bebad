"""WARC archives as a Spark data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

The writer puts each task's records into files of its own and lists the files of the
tasks that committed in a manifest, so files of failed or repeated attempts are never read. The
reader deals the listed files into partitions of about equal bytes; of a folder without a manifest it takes
every ``.warc`` and ``.warc.gz`` file. It reads a record's
headers first, tests the pushed filters on them, and steps over the payload of every
record that is unwanted, or of all records if ``payload`` is ``false``.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)

from engagemart.llm.common import counted, new_path, small

#: A new file begins beyond this size; a read partition holds about this much.
FILE_BYTES, PARTITION_BYTES = 1 << 30, 128 << 20
#: Records and payload bytes of a batch handed to Spark, unless one record is larger.
BATCH_RECORDS, BATCH_BYTES = 1_000, 4 << 20
MANIFEST = "_manifest.json"
SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, payload_digest string, "
    "payload_bytes bigint, refers_to string, payload binary"
)
_BATCH = pa.schema(
    [
        (field.split()[0], {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[field.split()[1]])
        for field in SCHEMA.split(", ")
    ]
)
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ORDER = {
    EqualTo: lambda a, b: a == b,
    GreaterThan: lambda a, b: a > b,
    GreaterThanOrEqual: lambda a, b: a >= b,
    LessThan: lambda a, b: a < b,
    LessThanOrEqual: lambda a, b: a <= b,
}


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _field(value: str) -> str:
    """A header value on one line."""
    return " ".join(value.split())


def record_bytes(row: dict) -> bytes:
    """One record. A revisit keeps the HTTP headers, whose length is the full payload's, without the payload."""
    payload = row["payload"] or b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if row["record_type"] == "revisit" else http + payload
    head = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": f"<{row['record_id']}>",
        "WARC-Date": row["date"],
        "WARC-Target-URI": _field(row["target_uri"] or ""),
        "WARC-Payload-Digest": f"sha1:{base32_sha1(payload)}",
    }
    if row["refers_to"] is not None:
        head |= {"WARC-Refers-To": f"<{row['refers_to']}>", "WARC-Profile": _PROFILE}
    head |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    lines = "".join(f"{name}: {value}\r\n" for name, value in head.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


@dataclass
class _Written(WriterCommitMessage):
    files: list[tuple[str, int]]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.file_bytes = int(options.get("filebytes", FILE_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            for first in range(0, batch.num_rows, 500):
                for row in batch.slice(first, 500).to_pylist():
                    if out is None or size >= self.file_bytes:
                        if out is not None:
                            out.close()
                            files.append((name, size))
                        name, size = f"part-{uuid4().hex}.warc", 0
                        out = store.open_output_stream(f"{root}/{name}")
                    size += out.write(record_bytes(row))
        if out is not None:
            out.close()
            files.append((name, size))
        return _Written(files)

    def commit(self, messages: list[_Written | None]) -> None:
        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        files = sorted(file for message in messages if message for file in message.files)
        with store.open_output_stream(f"{root}/{MANIFEST}") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list[_Written | None]) -> None:
        store, root = fs.FileSystem.from_uri(self.path)
        for message in messages:
            for name, _ in message.files if message else ():
                store.delete_file(f"{root}/{name}")


@dataclass
class _Files(InputPartition):
    names: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() != "false"
        self.partition_bytes = int(options.get("partitionbytes", PARTITION_BYTES))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes every test of a header; tests of the payload go back to Spark."""
        for test in filters:
            name = test.attribute[0] if len(getattr(test, "attribute", ())) == 1 else ""
            if name in ("", "payload") or type(test) not in {*_ORDER, In, IsNotNull}:
                yield test
            else:
                self.tests.append((type(test).__name__, name, getattr(test, "value", None)))

    def partitions(self) -> list[_Files]:
        store, root = fs.FileSystem.from_uri(self.path)
        if store.get_file_info(f"{root}/{MANIFEST}").type == fs.FileType.File:
            with store.open_input_stream(f"{root}/{MANIFEST}") as manifest:
                files = json.loads(manifest.read())
        else:
            found = store.get_file_info(fs.FileSelector(root))
            files = sorted((f.base_name, f.size) for f in found if f.base_name.endswith((".warc", ".warc.gz")))
        dealt, held = [], self.partition_bytes
        for name, size in files:
            if held >= self.partition_bytes:
                dealt.append(_Files([]))
                held = 0
            dealt[-1].names.append(name)
            held += size
        return dealt or [_Files([])]

    def _wanted(self, record: dict) -> bool:
        for kind, name, value in self.tests:
            own = record[name]
            if own is None:
                return False
            if kind == "In" and own not in value:
                return False
            for order, holds in _ORDER.items():
                if kind == order.__name__ and not holds(own, value):
                    return False
        return True

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for row in self._rows(partition):
            rows.append(row)
            held += len(row["payload"] or b"")
            if len(rows) >= BATCH_RECORDS or held >= BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(rows, _BATCH)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _BATCH)

    def _rows(self, partition: _Files) -> Iterator[dict]:
        store, root = fs.FileSystem.from_uri(self.path)
        for name in partition.names:
            with store.open_input_file(f"{root}/{name}") as file:
                if name.endswith(".gz"):  # any number of members
                    with gzip.GzipFile(fileobj=file) as unpacked:
                        yield from self._records(unpacked)
                else:
                    yield from self._records(file)

    def _records(self, file) -> Iterator[dict]:
        reader = _Buffered(file)
        while (version := reader.line()) is not None:
            if not version:  # blank lines between records
                continue
            if not version.startswith(b"WARC/"):
                raise ValueError(f"no WARC record where one should begin: {version[:40]!r}")
            head = reader.headers()
            size = int(head["content-length"])
            begin, length = reader.place, None
            if head.get("content-type", "").startswith("application/http") and size:
                reader.line()  # the HTTP status
                length = reader.headers().get("content-length", "")
            left = size - (reader.place - begin)
            kind = head.get("warc-type")
            if not (length or "").isdecimal():  # the block's own, but a revisit's leaves out the payload
                length = None if kind == "revisit" else left
            digest = head.get("warc-payload-digest")
            record = {
                "record_id": _bare(head.get("warc-record-id")),
                "record_type": kind,
                "target_uri": head.get("warc-target-uri"),
                "date": head.get("warc-date"),
                "payload_digest": digest and digest.rpartition(":")[2],
                "payload_bytes": None if length is None else int(length),
                "refers_to": _bare(head.get("warc-refers-to")),
            }
            wanted, payload = self._wanted(record), None
            if wanted and self.payload and kind != "revisit":
                payload = reader.take(left)
            else:
                reader.skip(left)
            if wanted:
                yield record | {"payload": payload}


def _bare(value: str | None) -> str | None:
    """A record id without its angle brackets."""
    return value and value.strip("<>")


class _Buffered:
    """Lines and stretches of a file, read in blocks; long stretches are stepped over unread."""

    def __init__(self, file, block: int = 1 << 18):
        self._file, self._block, self._held, self._at = file, block, b"", 0
        self.place = 0

    def line(self) -> bytes | None:
        while (end := self._held.find(b"\r\n", self._at)) < 0:
            more = self._file.read(self._block)
            if not more:
                return None
            self._held, self._at = self._held[self._at :] + more, 0
        line = self._held[self._at : end]
        self.place += end + 2 - self._at
        self._at = end + 2
        return line

    def headers(self) -> dict[str, str]:
        found = {}
        while line := self.line():
            name, _, value = line.decode(errors="replace").partition(":")
            found[name.strip().lower()] = value.strip()
        return found

    def take(self, size: int) -> bytes:
        got = self._held[self._at : self._at + size]
        self._at += len(got)
        if len(got) < size:
            got += self._file.read(size - len(got))
        self.place += size
        return got

    def skip(self, size: int) -> None:
        self.place += size
        held = len(self._held) - self._at
        if size <= held:
            self._at += size
        else:
            self._file.seek(self._file.tell() + size - held)
            self._held, self._at = b"", 0


class WarcDataSource(DataSource):
    """Options: path; partitionBytes, payload (reading); fileBytes (writing)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def archive_records(
    pages: DataFrame, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``pages`` as records to write.

    Of equal payloads of at least ``least_bytes`` bytes, the one with the largest id is a
    response and the others revisit it; smaller payloads are all responses. NULL html is an empty
    payload. Repeated rows of the response's id are responses too, and so are rows without an id.
    """
    rows = pages.select(
        pages[id_col].alias("_id"),
        pages[url_col].alias("target_uri"),
        F.coalesce(pages[html_col], F.lit("")).cast("binary").alias("payload"),
    ).withColumn("_digest", F.sha2("payload", 256))
    # only payloads that come again are looked up
    repeated = (
        rows.filter(F.octet_length("payload") >= least_bytes)
        .groupBy("_digest")
        .agg(F.max("_id").alias("_response"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .drop("_n")
    )
    repeated, known = counted(repeated, "warc-repeated")
    joined = rows.join(small(repeated, known, 120), "_digest", "left")
    revisit = F.col("_response") != F.col("_id")
    return joined.select(
        F.concat(F.lit("urn:page:"), F.coalesce(F.col("_id").cast("string"), F.lit("none"))).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.lit("1970-01-01T00:00:00Z").alias("date"),
        F.lit(None).cast("string").alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(revisit, F.concat(F.lit("urn:page:"), F.col("_response").cast("string"))).alias("refers_to"),
        "payload",
    )


def base32_of_hex(digits: Column) -> Column:
    """Upper-case base32 of a 160-bit number in hexadecimal."""
    # five hexadecimal digits are four of base 32
    groups = [F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """Every response and revisit of the archives in ``path``.

    record_id, record_type, refers_to, payload_bytes and payload_digest. Of responses the payloads are read, and length and
    digest are theirs, whatever the headers say; revisits have no payload, theirs come from headers. Each of the
    two reads pushes its record type down, so it steps over the other's payloads.
    """
    register(spark)
    whole = spark.read.format("warc").load(path).filter("record_type = 'response'")
    heads = spark.read.format("warc").option("payload", "false").load(path).filter("record_type = 'revisit'")
    columns = ["record_id", "record_type", "refers_to"]
    responses = whole.select(
        *columns,
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_of_hex(F.sha1("payload")).alias("payload_digest"),
    )
    return responses.unionByName(heads.select(*columns, "payload_bytes", "payload_digest"))


def roundtrip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Every page written as a WARC record and read back from the archives.

    One row per page: page_id, payload_bytes, payload_digest, record_type, refers_to.
    """
    spark = pages.sparkSession
    register(spark)
    path = new_path(spark, "warc")
    archive_records(pages, least_bytes).write.format("warc").mode("append").save(path)
    read = read_back(spark, path)

    def page(column: str):
        return F.nullif(F.regexp_extract(column, "^urn:page:(-?[0-9]+)$", 1), F.lit("")).cast("long")

    return read.select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.when(F.col("refers_to").isNotNull(), page("refers_to")).alias("refers_to"),
    )
