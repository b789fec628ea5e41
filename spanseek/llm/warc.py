"""WARC archives as a Python data source, with payloads stored once.

``write`` turns rows of records into files, one or more per task, each record a
gzip member that carries its length (subfield ``sl``), so that a reader passes
over it without inflating it. A manifest, written when all tasks have
succeeded, names the files that count; files of lost tasks are never read.

``read`` plans partitions from file sizes. A task parses the headers of a record
first, tests them against the pushed predicates (record type and other header
columns) and inflates and decodes the payload only of records that pass, and
only if payloads are asked for. Filters are pushed if
``spark.sql.python.filterPushdown.enabled`` is set, which ``read`` sets.

Null payloads are empty. A null or empty URL leaves out the header and reads as
null; characters that may not stand in a header are percent-encoded. Archives of
an empty table have no records.
"""

from __future__ import annotations

import base64
import json
import struct
import time
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from ..staging import stage

# Smaller payloads are always stored.
LEAST_SHARED = 1000
PARTITION_BYTES = 64 << 20
FILE_BYTES = 256 << 20
MANIFEST = "_manifest.json"
_HEAD = 8192  # inflated at first, to find the headers
_BATCH_BYTES = 4 << 20

WRITE_SCHEMA = "record_id string, record_type string, target_uri string, refers_to string, payload_sha1 string, payload_bytes bigint, payload binary"
READ_SCHEMA = (
    "record_id string, record_type string, target_uri string, refers_to string, payload_sha1 string, "
    "payload_bytes bigint, date string, content_length bigint, payload binary"
)
_ARROW = pa.schema(
    [(n, pa.string()) for n in ("record_id", "record_type", "target_uri", "refers_to", "payload_sha1")]
    + [("payload_bytes", pa.int64()), ("date", pa.string()), ("content_length", pa.int64()), ("payload", pa.binary())]
)
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    system, name = pafs.FileSystem.from_uri(path)
    return system, name.rstrip("/")


# --- records ------------------------------------------------------------------


def record(row: dict, date: str) -> bytes:
    """One WARC record; a revisit holds the HTTP headers but not the payload."""
    payload = row["payload"] or b""
    length = len(payload) if row["payload_bytes"] is None else row["payload_bytes"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    revisit = row["record_type"] == "revisit"
    block = http if revisit else http + payload
    headers = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", date)]
    if row["target_uri"]:
        headers.append(("WARC-Target-URI", quote(row["target_uri"], safe="!#$%&'()*+,/:;=?@[]~")))
    if row["payload_sha1"]:
        digest = base64.b32encode(bytes.fromhex(row["payload_sha1"])).decode()
        headers.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if revisit:
        headers += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", row["refers_to"])]
    headers += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member whose header tells its compressed and its full length."""
    deflate = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    size = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, size, len(data) & 0xFFFFFFFF)
    header = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra
    return header + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def parse_headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:]) if v}


class Member:
    """A gzip member at the front of ``data``; inflated no further than asked."""

    def __init__(self, data: memoryview) -> None:
        self._data = data
        self._inflate = zlib.decompressobj(31)
        self.text = self._inflate.decompress(data, _HEAD)
        # Headers may be longer than what was inflated at first.
        while b"\r\n\r\n" not in self.text and self._inflate.unconsumed_tail:
            self.text += self._inflate.decompress(self._inflate.unconsumed_tail, _HEAD)

    def rest(self) -> bytes:
        """The whole record."""
        while not self._inflate.eof:
            more = self._inflate.decompress(self._inflate.unconsumed_tail)
            if not more and not self._inflate.unconsumed_tail and not self._inflate.eof:
                raise ValueError("a WARC record ends early")
            self.text += more
        return self.text

    def size(self) -> int:
        """Compressed length: from the header if it tells, else by inflating."""
        if self._data[3] & 4 and bytes(self._data[12:14]) == b"sl":
            return struct.unpack("<I", self._data[16:20])[0]
        while not self._inflate.eof:
            self._inflate.decompress(self._inflate.unconsumed_tail, 1 << 20)
        return len(self._data) - len(self._inflate.unused_data)


def _row(headers: dict[str, str]) -> dict:
    digest = headers.get("warc-payload-digest", "")
    sha1 = base64.b32decode(digest[5:]).hex() if digest.startswith("sha1:") and len(digest) == 37 else None
    return {
        "record_id": headers.get("warc-record-id"),
        "record_type": headers.get("warc-type"),
        "target_uri": headers.get("warc-target-uri"),
        "refers_to": headers.get("warc-refers-to"),
        "payload_sha1": sha1,
        "payload_bytes": None,
        "date": headers.get("warc-date"),
        "content_length": int(headers.get("content-length", 0)),
        "payload": None,
    }


# --- the source -----------------------------------------------------------------

_HEADER_COLUMNS = {"record_id", "record_type", "target_uri", "refers_to", "payload_sha1", "date", "content_length"}


def _accepts(row: dict, tests: list[tuple]) -> bool:
    for kind, column, value in tests:
        own = row[column]
        if kind == "null":
            ok = own is None
        elif own is None:
            ok = False
        elif kind == "=":
            ok = own == value
        elif kind == "in":
            ok = own in value
        elif kind == "starts":
            ok = own.startswith(value)
        elif kind == ">=":
            ok = own >= value
        elif kind == "<=":
            ok = own <= value
        else:
            ok = True
        if not ok:
            return False
    return True


@dataclass
class Files(ds.InputPartition):
    names: tuple[str, ...]


class WarcReader(ds.DataSourceReader):
    def __init__(self, options: dict) -> None:
        self._path = options["path"]
        self._payload = options.get("payload", "true").lower() == "true"
        self._bytes = int(options.get("partitionbytes", PARTITION_BYTES))
        self.tests: list[tuple] = []

    def pushFilters(self, filters: list[ds.Filter]):
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            test = None
            if column in _HEADER_COLUMNS:
                if isinstance(f, ds.EqualTo):
                    test = ("=", column, f.value)
                elif isinstance(f, ds.In):
                    test = ("in", column, tuple(f.value))
                elif isinstance(f, ds.StringStartsWith):
                    test = ("starts", column, f.value)
                elif isinstance(f, ds.GreaterThanOrEqual):
                    test = (">=", column, f.value)
                elif isinstance(f, ds.LessThanOrEqual):
                    test = ("<=", column, f.value)
                elif isinstance(f, ds.IsNull):
                    test = ("null", column, None)
                elif isinstance(f, ds.IsNotNull):
                    test = ("set", column, None)
            if test:
                self.tests.append(test)
            else:
                yield f

    def partitions(self) -> list[Files]:
        """Files of together about the wanted size, large ones first; a file is not split."""
        system, base = _open(self._path)
        if system.get_file_info(f"{base}/{MANIFEST}").type == pafs.FileType.File:
            with system.open_input_stream(f"{base}/{MANIFEST}") as stream:
                sizes = {f"{base}/{name}": size for name, size in json.loads(stream.read())}
        else:
            found = system.get_file_info(pafs.FileSelector(base, recursive=True))
            sizes = {i.path: i.size for i in found if i.type == pafs.FileType.File and i.path.endswith((".warc", ".warc.gz"))}
        out, group, size = [], [], 0
        for name in sorted(sizes, key=lambda n: (-sizes[n], n)):
            if group and size + sizes[name] > self._bytes:
                out.append(Files(tuple(group)))
                group, size = [], 0
            group.append(name)
            size += sizes[name]
        return [*out, Files(tuple(group))]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = _open(self._path)
        rows: list[dict] = []
        size = 0
        for name in partition.names:
            for row in self._records(system, name):
                rows.append(row)
                size += len(row["payload"] or b"") + 256
                if size > _BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _ARROW)

    def _records(self, system: pafs.FileSystem, name: str) -> Iterator[dict]:
        with system.open_input_file(name) as file:
            end, at = file.size(), 0
            plain = file.read(2) != b"\x1f\x8b" if end else True
            window, base = memoryview(b""), 0

            def view(at: int, n: int) -> memoryview:
                """At least ``n`` bytes from ``at``, as far as the file goes; read ahead in blocks."""
                nonlocal window, base
                if at < base or at + n > base + len(window):
                    file.seek(at)
                    base, window = at, memoryview(file.read(max(n, _BATCH_BYTES)))
                return window[at - base :]

            while at < end:
                if plain:
                    n = _HEAD
                    while (cut := bytes(view(at, n)[:n]).find(b"\r\n\r\n")) < 0 and at + n < end:
                        n *= 2
                    headers = parse_headers(bytes(view(at, n)[:cut]))
                    row = _row(headers)
                    start, at = at + cut + 4, at + cut + 4 + row["content_length"] + 4
                    if _accepts(row, self.tests):
                        self._fill(row, headers, bytes(view(start, row["content_length"])[: row["content_length"]]))
                        yield row
                    continue
                data = view(at, min(end - at, 1 << 16))
                if data[3] & 4 and bytes(data[12:14]) == b"sl":
                    data = view(at, struct.unpack("<I", data[16:20])[0])
                else:
                    data = view(at, end - at)  # an archive without lengths is held as a whole
                one = Member(data)
                cut = one.text.find(b"\r\n\r\n")
                headers = parse_headers(one.text[:cut])
                row = _row(headers)
                if _accepts(row, self.tests):
                    whole = one.rest() if self._payload or row["record_type"] == "revisit" else one.text
                    self._fill(row, headers, whole[cut + 4 : cut + 4 + row["content_length"]])
                    yield row
                at += one.size()

    def _fill(self, row: dict, headers: dict[str, str], block: bytes) -> None:
        payload = block
        if headers.get("content-type", "").startswith("application/http"):
            head, _, payload = block.partition(b"\r\n\r\n")
            length = parse_headers(head).get("content-length", "")
            row["payload_bytes"] = int(length) if length.isdigit() else len(payload)
        else:
            row["payload_bytes"] = row["content_length"]
        row["payload"] = payload if self._payload and row["record_type"] != "revisit" else None


@dataclass
class Written(ds.WriterCommitMessage):
    files: list


class WarcWriter(ds.DataSourceArrowWriter):
    def __init__(self, options: dict) -> None:
        self._path = options["path"]
        self._date = time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, base = _open(self._path)
        system.create_dir(base, recursive=True)
        files, out, size, name = [], None, 0, ""
        for batch in iterator:
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).to_pylist():
                    if out is None:
                        name, size = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = system.open_output_stream(f"{base}/{name}", compression=None)
                    data = member(record(row, self._date))
                    out.write(data)
                    size += len(data)
                    if size >= FILE_BYTES:
                        out.close()
                        files.append((name, size))
                        out = None
        if out is not None:
            out.close()
            files.append((name, size))
        return Written(files)

    def commit(self, messages: list) -> None:
        system, base = _open(self._path)
        system.create_dir(base, recursive=True)
        named = [f for m in messages if m for f in m.files]
        with system.open_output_stream(f"{base}/{MANIFEST}") as out:
            out.write(json.dumps(named).encode())


class WarcSource(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options)


def write(records: DataFrame, path: str) -> None:
    """Write ``records`` (columns of ``WRITE_SCHEMA``) to the new folder ``path``, a URI that executors share."""
    records.sparkSession.dataSource.register(WarcSource)
    records.select(*[c.split()[0] for c in WRITE_SCHEMA.split(", ")]).write.format("warc").mode("append").save(path)


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of the archives in ``path``; filters on header columns are applied before payloads are touched."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def share_payloads(
    pages: DataFrame, key: str, payload: str, url: str, prefix: str = "urn:x-page:", least: int = LEAST_SHARED
) -> DataFrame:
    """Records for rows of ``pages``: of equal payloads of ``least`` bytes or more, that with the largest key is stored.

    The others become revisits of it. Payloads are equal if their SHA-1 is.
    Digests travel without payloads, and a revisit is joined to its row by key
    and digest, so a group of copies is no group in any join of payloads. Rows
    that repeat the largest key and its payload are all stored. A null key counts
    as smaller than any other; if all keys of a group are null, all are stored.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    sized = pages.select(F.col(key).alias("key"), F.sha1(body).alias("sha1"), F.octet_length(body).alias("bytes"))
    large = stage(sized.where(F.col("bytes") >= least).select("key", "sha1"), "digests")
    counts = [F.count("*").alias("n"), F.count("key").alias("n_keys")]
    kept = large.groupBy("sha1").agg(F.max("key").alias("stored"), F.min("key").alias("least"), *counts)
    kept = kept.where("least < stored OR 0 < n_keys AND n_keys < n").select("sha1", "stored")
    again = large.join(kept, "sha1").where("key IS NULL OR key < stored").distinct()
    again = again.select(F.col("sha1").alias("again_sha1"), F.col("key").alias("again_key"), "stored")

    def identifier(column: str):
        return F.concat(F.lit(f"<{prefix}"), F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(">"))

    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("target_uri"), body.alias("body"))
    same = (F.col("sha1") == F.col("again_sha1")) & F.col("key").eqNullSafe(F.col("again_key"))
    rows = rows.withColumn("sha1", F.sha1("body")).join(again, same, "left")
    is_again = F.col("stored").isNotNull()
    return rows.select(
        identifier("key").alias("record_id"),
        F.when(is_again, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.when(is_again, identifier("stored")).alias("refers_to"),
        F.col("sha1").alias("payload_sha1"),
        F.octet_length("body").cast("bigint").alias("payload_bytes"),
        F.when(~is_again, F.col("body")).alias("payload"),
    )
