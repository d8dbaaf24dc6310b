"""WARC archives: a writer with payload deduplication and a Python data source
that reads headers first and skips the payloads it does not need.

The writer compresses each record as two gzip members, headers and payload.
The member's extra field carries its lengths (subfield ``sl``), so a reader can
step over a payload without inflating it; any other reader sees an ordinary
compressed archive.  Files without that field, and uncompressed files, are read
as streams.
"""

from __future__ import annotations

import gzip
import io
import json
import struct
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, Filter, In,
                                    InputPartition, IsNotNull, IsNull, StringContains,
                                    StringEndsWith, StringStartsWith)

VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The tables carry no capture time.
DATE = "1970-01-01T00:00:00Z"
RECORD_URN = "urn:x-page:"
MANIFEST = "_manifest.json"
MAX_FILE_BYTES = 256 << 20
PARTITION_BYTES = 64 << 20
BATCH_BYTES = 8 << 20
SCHEMA = ("record_id string, record_type string, target_uri string, refers_to string, "
          "payload_digest string, content_type string, http_status int, payload_bytes long, "
          "headers map<string,string>, payload binary")


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path)


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 20 bits at a time make four digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV",
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


# --- writing -----------------------------------------------------------------

def _member(data: bytes) -> bytes:
    """One gzip member whose extra field holds its whole and inflated length."""
    deflate = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    size = 10 + 2 + 12 + len(body) + 8
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack(
        "<H2sHII", 12, b"sl", 8, size & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def _uri(url: str | None, record: str) -> str:
    return urllib.parse.quote(url, safe="%/:=&?~#+!$,;'@()*[]|^`{}\"<>\\-_.") if url else record


def record_bytes(record: str, url: str | None, digest: str, payload: bytes,
                 refers_to: str | None) -> bytes:
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    body = b"" if refers_to else payload
    lines = [VERSION, f"WARC-Type: {'revisit' if refers_to else 'response'}",
             f"WARC-Record-ID: <{record}>", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {_uri(url, record)}", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{refers_to}>"]
    lines += ["Content-Type: application/http;msgtype=response",
              f"Content-Length: {len(http) + len(body)}"]
    head = "\r\n".join(lines).encode() + b"\r\n\r\n" + http
    return _member(head) + _member(body + b"\r\n\r\n")


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html", least_bytes: int = 0) -> None:
    """Writes one record per row into new archive files under ``path`` and then
    the list of the complete files, so files of lost attempts are never read.

    Of records with equal payloads of at least ``least_bytes`` bytes the one
    with the largest id is a response and the others revisit it; smaller
    payloads are all responses.  Rows that share the largest id are all
    responses, and so are rows without an id.  A null payload is empty; a null
    address is replaced by the record's name.  An empty table makes an empty
    list of files.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("payload")).withColumn(
        "digest", base32_sha1(F.col("payload")))
    large = F.octet_length("payload") >= least_bytes
    keep = rows.where(large).groupBy("digest").agg(F.max("id").alias("keep"))
    joined = rows.join(keep, "digest", "left").withColumn(
        "refers", F.when(large & (F.col("id") < F.col("keep")), F.col("keep")))
    target = path.rstrip("/")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = file_system(target)
        done, out, name, size, count = [], None, "", 0, 0
        for batch in batches:
            for row in batch.itertuples(index=False):
                if out is None:
                    name, size, count = f"part-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                record = RECORD_URN + (str(int(row.id)) if pd.notna(row.id) else uuid.uuid4().hex)
                refers = RECORD_URN + str(int(row.refers)) if pd.notna(row.refers) else None
                data = record_bytes(record, row.url, row.digest, bytes(row.payload), refers)
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= MAX_FILE_BYTES:
                    out.close()
                    done.append((name, size, count))
                    out = None
        if out is not None:
            out.close()
            done.append((name, size, count))
        yield pd.DataFrame(done, columns=["name", "bytes", "records"])

    system, root = file_system(target)
    system.create_dir(root, recursive=True)
    # One row per file.
    files = joined.select("id", "url", "digest", "payload", "refers").mapInPandas(
        write, "name string, bytes long, records long").collect()
    with system.open_output_stream(f"{root}/{MANIFEST}") as out:
        out.write(json.dumps([[r["name"], r["bytes"], r["records"]] for r in files]).encode())


# --- reading -----------------------------------------------------------------

class _Stream:
    """Uncompressed bytes of an archive, with a skip that seeks where it can."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size

    def line(self) -> bytes:
        out = bytearray()
        while not out.endswith(b"\n"):
            c = self.read(1)
            if not c:
                break
            out += c
        return bytes(out)

    def read(self, n: int) -> bytes:
        return self.file.read(n)

    def skip(self, n: int) -> None:
        if self.size < 0:
            while n > 0 and (got := len(self.file.read(min(n, 1 << 20)))):
                n -= got
        else:
            self.file.seek(min(self.file.tell() + n, self.size))


class _Members(_Stream):
    """Gzip members with known lengths: skipping does not inflate."""

    def __init__(self, file, size: int):
        super().__init__(file, size)
        self.data, self.at = b"", 0

    def _head(self) -> tuple[int, int] | None:
        start = self.file.tell()
        head = self.file.read(24)
        self.file.seek(start)
        return struct.unpack("<II", head[16:24]) if len(head) == 24 else None

    def _load(self) -> bool:
        lengths = self._head()
        if lengths is None:
            return False
        member = self.file.read(lengths[0])
        self.data, self.at = zlib.decompress(member, 31), 0
        return True

    def line(self) -> bytes:
        if self.at >= len(self.data) and not self._load():
            return b""
        end = self.data.find(b"\n", self.at) + 1
        if end == 0:
            return super().line()
        out, self.at = self.data[self.at:end], end
        return out

    def read(self, n: int) -> bytes:
        parts = []
        while n > 0:
            if self.at >= len(self.data) and not self._load():
                break
            part = self.data[self.at:self.at + n]
            self.at += len(part)
            n -= len(part)
            parts.append(part)
        return b"".join(parts)

    def skip(self, n: int) -> None:
        while n > 0:
            left = len(self.data) - self.at
            if left:
                step = min(left, n)
                self.at += step
                n -= step
                continue
            lengths = self._head()
            if lengths is None:
                return
            if lengths[1] <= n:
                self.file.seek(self.file.tell() + lengths[0])
                n -= lengths[1]
            else:
                self._load()


def open_stream(file, size: int) -> _Stream:
    head = file.read(18)
    file.seek(0)
    if head[:2] != b"\x1f\x8b":
        return _Stream(io.BufferedReader(file) if isinstance(file, io.RawIOBase) else file, size)
    if len(head) == 18 and head[3] == 4 and head[12:16] == b"sl\x08\x00":
        return _Members(file, size)
    return _Stream(gzip.GzipFile(fileobj=file), -1)


def _fields(stream: _Stream) -> dict[str, str]:
    out: dict[str, str] = {}
    last = None
    while (line := stream.line()) not in (b"\r\n", b"\n", b""):
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[:1] in (" ", "\t") and last:
            out[last] += " " + text.strip()
        else:
            last, _, value = text.partition(":")
            out[last] = value.strip()
    return out


def records(stream: _Stream, wanted, payloads: bool) -> Iterator[dict]:
    """Records that pass ``wanted`` (a test of the header fields); all others,
    and payloads when not asked for, are skipped undecoded."""
    while True:
        line = stream.line()
        while line in (b"\r\n", b"\n"):
            line = stream.line()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        head = _fields(stream)
        lower = {k.lower(): v for k, v in head.items()}
        length = int(lower.get("content-length", 0))
        row = {"record_id": lower.get("warc-record-id", "").strip("<>"),
               "record_type": lower.get("warc-type"),
               "target_uri": lower.get("warc-target-uri"),
               "refers_to": lower["warc-refers-to"].strip("<>") if "warc-refers-to" in lower else None,
               "payload_digest": lower.get("warc-payload-digest", "").rpartition(":")[2] or None,
               "content_type": lower.get("content-type"), "headers": head,
               "http_status": None, "payload_bytes": None, "payload": None}
        if not wanted(row):
            stream.skip(length + 4)
            continue
        left = length
        if (row["content_type"] or "").startswith("application/http") and length:
            status = stream.line()
            left -= len(status)
            fields = {}
            while left > 0 and (line := stream.line()) not in (b"\r\n", b"\n", b""):
                left -= len(line)
                name, _, value = line.decode("utf-8", "replace").partition(":")
                fields[name.strip().lower()] = value.strip()
            left -= len(line) if left > 0 else 0
            parts = status.split(b" ")
            row["http_status"] = int(parts[1]) if len(parts) > 1 and parts[1][:3].isdigit() else None
            declared = fields.get("content-length", "")
            row["payload_bytes"] = int(declared) if declared.isdigit() else left
        else:
            row["payload_bytes"] = length
        if payloads and row["record_type"] != "revisit":
            row["payload"] = stream.read(left)
            stream.skip(4)
        else:
            stream.skip(left + 4)
        yield row


_HEADER_COLUMNS = ("record_id", "record_type", "target_uri", "refers_to", "payload_digest",
                   "content_type")
_TESTS = {EqualTo: lambda v, f: v is not None and v == f.value,
          In: lambda v, f: v is not None and v in f.value,
          IsNull: lambda v, f: v is None, IsNotNull: lambda v, f: v is not None,
          StringStartsWith: lambda v, f: v is not None and v.startswith(f.value),
          StringEndsWith: lambda v, f: v is not None and v.endswith(f.value),
          StringContains: lambda v, f: v is not None and f.value in v}


class Files(InputPartition):
    def __init__(self, files: list[tuple[str, int]]):
        super().__init__(0)
        self.files = files


class WarcReader(DataSourceReader):
    def __init__(self, options: dict, schema):
        self.path = options["path"]
        self.payloads = options.get("payload", "true").lower() == "true"
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if type(f) in _TESTS and f.attribute[0] in _HEADER_COLUMNS and len(f.attribute) == 1:
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        """Files packed into partitions by size, the largest first."""
        system, root = file_system(self.path)
        if system.get_file_info(root).type == fs.FileType.File:
            return [Files([(root, system.get_file_info(root).size)])]
        if system.get_file_info(f"{root}/{MANIFEST}").type == fs.FileType.File:
            with system.open_input_stream(f"{root}/{MANIFEST}") as listed:
                files = [(f"{root}/{name}", size) for name, size, _ in json.loads(listed.read())]
        else:
            files = [(f.path, f.size) for f in system.get_file_info(fs.FileSelector(root, recursive=True))
                     if f.path.endswith((".warc", ".warc.gz"))]
        plans: list[list] = []
        used = PARTITION_BYTES
        for name, size in sorted(files, key=lambda f: -f[1]):
            if used + size > PARTITION_BYTES:
                plans.append([])
                used = 0
            plans[-1].append((name, size))
            used += size
        return [Files(p) for p in plans]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(self.path)
        schema = pa.schema([
            ("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()),
            ("refers_to", pa.string()), ("payload_digest", pa.string()),
            ("content_type", pa.string()), ("http_status", pa.int32()),
            ("payload_bytes", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())),
            ("payload", pa.binary())])

        def wanted(row: dict) -> bool:
            return all(_TESTS[type(f)](row[f.attribute[0]], f) for f in self.filters)

        def batch(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [r | {"headers": list(r["headers"].items())} for r in rows], schema=schema)

        rows, held = [], 0
        for name, size in partition.files if partition else []:
            with system.open_input_file(name) as file:
                for row in records(open_stream(file, size), wanted, self.payloads):
                    rows.append(row)
                    held += 1000 + len(row["payload"] or b"")
                    if held >= BATCH_BYTES:
                        yield batch(rows)
                        rows, held = [], 0
        if rows:
            yield batch(rows)


class WarcDataSource(DataSource):
    """``spark.read.format("warc").load(path)``; option ``payload`` false leaves
    every payload undecoded and null."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options, schema)


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of the archives under ``path``; equality, membership, null and
    string tests of header columns reach the reader."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of
    every record: responses are decoded and their digest is taken again from the
    payload read; revisits are read by their headers alone."""
    number = lambda c: F.expr(
        f"try_cast(substring({c}, {len(RECORD_URN) + 1}) AS BIGINT)")
    full = read_archive(spark, path).where(F.col("record_type") == "response").select(
        number("record_id").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"), "record_type",
        F.lit(None).cast("long").alias("refers_to"))
    again = read_archive(spark, path, payload=False).where(F.col("record_type") == "revisit").select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number("refers_to").alias("refers_to"))
    return full.unionAll(again)
