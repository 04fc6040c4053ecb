"""WARC archives as a PySpark Python data source, for reading and writing.

Reading plans one partition for each archive file. Of every record the headers are parsed
first; pushed-down conditions on its type and header columns are decided on them, and the
content of a record that fails (or of every record, with option ``payload=false``) is
skipped, not decoded: by a seek in plain files and, in compressed ones, by the member
lengths that the writer notes in the gzip header (field ``sl`` of the WARC format's annex on
compression); files without them are inflated past the content.

Writing makes a compressed file for each task (more, if one grows large), a gzip member for
each record. A task's files count only once the job's commit lists them in a manifest, so
files of lost or repeated attempts are never read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import sys
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull,
    StringStartsWith, WriterCommitMessage)

from arquivo.llm import common

#: Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Column, and the header it is read from and written to.
HEADERS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
           "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To"}
COLUMNS = "record_type string, record_id string, target_uri string, date string, payload_digest string, refers_to string"
READ_BYTES = 1 << 18
BATCH_BYTES = 4 << 20  # of payloads in an Arrow batch
FILE_BYTES = 256 << 20  # after which a task goes on in a new file


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] or path.startswith("/") else (fs.LocalFileSystem(), path)


# --- records -------------------------------------------------------------------------


def record(row: dict) -> bytes:
    """A record: HTTP headers and payload for a response, HTTP headers alone for a revisit."""
    payload = row["payload"] or b""
    revisit = row["record_type"] == "revisit"
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    fields = [(HEADERS[c], row.get(c)) for c in HEADERS if c != "payload_digest"]
    fields.append((HEADERS["payload_digest"], "sha1:" + digest(payload)))
    if revisit:
        fields.append(("WARC-Profile", REVISIT_PROFILE))
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    # A line break in a value would end its header.
    lines = [f"{k}: {' '.join(v.split())}".encode("utf-8", "replace") for k, v in fields if v is not None]
    return b"\r\n".join([VERSION, *lines, b"", block]) + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member whose header notes its own and the data's length."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    size = 10 + 2 + 12 + len(body) + len(tail)
    return (b"\x1f\x8b\x08\x04" + b"\0" * 5 + b"\xff" + struct.pack("<H", 12)
            + b"sl" + struct.pack("<HII", 8, size & 0xFFFFFFFF, len(data) & 0xFFFFFFFF) + body + tail)


class _Plain:
    """The bytes of an uncompressed archive."""

    def __init__(self, file):
        self.file, self.buffer = file, b""

    def more(self) -> bytes:
        return self.file.read(READ_BYTES)

    def _grow(self) -> bool:
        more = self.more()
        self.buffer += more
        return bool(more)

    def headers(self) -> bytes | None:
        """What stands up to the next empty line, line breaks before it left out."""
        while not self.buffer.lstrip(b"\r\n"):
            if not self._grow():
                return None
        self.buffer = self.buffer.lstrip(b"\r\n")
        while b"\r\n\r\n" not in self.buffer:
            if not self._grow():
                raise ValueError("headers end early")
        head, _, self.buffer = self.buffer.partition(b"\r\n\r\n")
        return head

    def read(self, n: int) -> bytes:
        parts, have = [self.buffer], len(self.buffer)
        while have < n:
            parts.append(self.more())
            have += len(parts[-1])
            if not parts[-1]:
                raise ValueError("a record ends early")
        data = b"".join(parts)
        self.buffer = data[n:]
        return data[:n]

    def skip(self, n: int) -> None:
        """Leave out ``n`` bytes, the rest of a record."""
        if n > len(self.buffer):
            self.file.seek(n - len(self.buffer), 1)
        self.buffer = self.buffer[n:]


class _Gzip(_Plain):
    """The bytes of a compressed archive, inflated as they are needed."""

    def __init__(self, file):
        super().__init__(file)
        self.raw, self.inflate, self.end = b"", None, None  # end: where the open member ends, if it says so

    def _raw(self, n: int) -> bool:
        while len(self.raw) < n:
            more = self.file.read(READ_BYTES)
            if not more:
                return False
            self.raw += more
        return True

    def more(self) -> bytes:
        while True:
            if self.inflate is None:
                if not self._raw(1):
                    return b""
                self.end = None
                if self._raw(24) and self.raw[:4] == b"\x1f\x8b\x08\x04" and self.raw[12:16] == b"sl\x08\0":
                    self.end = self.file.tell() - len(self.raw) + struct.unpack("<I", self.raw[16:20])[0]
                self.inflate = zlib.decompressobj(31)
            if not self._raw(1):
                raise ValueError("a gzip member ends early")
            # Little at first: the headers of a record are enough to decide on it.
            out = self.inflate.decompress(self.raw, READ_BYTES if self.buffer else 2048)
            self.raw = self.inflate.unconsumed_tail
            if self.inflate.eof:
                self.raw, self.inflate = self.inflate.unused_data, None
            if out:
                return out

    def skip(self, n: int) -> None:
        if n > len(self.buffer) and self.inflate is not None and self.end is not None:
            self.file.seek(self.end)  # a member is a record: its content is what is left of it
            self.buffer, self.raw, self.inflate, self.end = b"", b"", None, None
            return
        while n > len(self.buffer):
            n -= len(self.buffer)
            self.buffer = self.more()
            if not self.buffer:
                raise ValueError("a record ends early")
        self.buffer = self.buffer[n:]


def records(file, compressed: bool, wanted, payloads: bool) -> Iterator[tuple[dict, bytes | None]]:
    """(headers, payload) of the records for whose headers ``wanted`` holds; payload is None
    where it is not read. Header names are in lower case."""
    source = _Gzip(file) if compressed else _Plain(file)
    while True:
        head = source.headers()
        if head is None:
            return
        lines = head.decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record starts at {lines[0][:40]!r}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        n = int(headers["content-length"])
        http = headers.get("content-type", "").startswith("application/http")
        if not wanted(headers):
            source.skip(n)
        elif payloads:
            block = source.read(n)
            if http:
                inner, _, block = block.partition(b"\r\n\r\n")
                headers |= {"http": inner.decode("latin-1")}
            yield headers, block
        elif http:  # the HTTP headers tell the payload's length
            before = source.headers()
            headers |= {"http": before.decode("latin-1")}
            source.skip(n - len(before) - 4)
            yield headers, None
        else:
            source.skip(n)
            yield headers, None


def _payload_length(headers: dict, payload: bytes | None) -> int | None:
    if payload is not None and headers.get("warc-type") != "revisit":
        return len(payload)
    for line in headers.get("http", "").split("\r\n"):
        name, _, value = line.partition(":")
        if name.strip().lower() == "content-length":
            return int(value)
    return None if "http" in headers else int(headers["content-length"])


def _columns(headers: dict) -> dict:
    out = {c: headers.get(h.lower()) for c, h in HEADERS.items()}
    if out["payload_digest"]:
        out["payload_digest"] = out["payload_digest"].rpartition(":")[2]
    return out


# --- data source ---------------------------------------------------------------------


class WarcFile(InputPartition):
    def __init__(self, path: str):
        self.path = path


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool):
        self.path, self.payload, self.conditions = path, payload, []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if isinstance(f, (EqualTo, EqualNullSafe, In, StringStartsWith, IsNotNull)) and f.attribute[0] in HEADERS:
                self.conditions.append(f)
            else:
                yield f

    def _wanted(self, headers: dict) -> bool:
        row = _columns(headers)
        for f in self.conditions:
            value = row[f.attribute[0]]
            if isinstance(f, EqualNullSafe):
                if value != f.value:
                    return False
            elif value is None:
                return False
            elif isinstance(f, EqualTo) and value != f.value or isinstance(f, In) and value not in f.value:
                return False
            elif isinstance(f, StringStartsWith) and not value.startswith(f.value):
                return False
        return True

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        system, path = _file_system(self.path)
        info = system.get_file_info(path)
        if info.type == fs.FileType.File:
            return [WarcFile(path)]
        found = [f for f in system.get_file_info(fs.FileSelector(path)) if f.type == fs.FileType.File]
        listed = [f for f in found if f.base_name.startswith("_committed-")]
        if listed:
            names = []
            for f in listed:
                with system.open_input_stream(f.path) as s:
                    names += json.loads(s.read())
            return [WarcFile(f"{path}/{name}") for name in sorted(names)]
        return [WarcFile(f.path) for f in sorted(found, key=lambda f: f.path) if f.base_name.endswith((".warc", ".warc.gz"))]

    def read(self, partition: WarcFile | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # there are no files
            return
        system, _ = _file_system(self.path)
        names = [*HEADERS, "payload_length", *(["payload"] if self.payload else [])]
        types = [pa.string()] * len(HEADERS) + [pa.int64()] + [pa.binary()] * self.payload

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        rows, size = [], 0
        with system.open_input_file(partition.path) as file:
            for headers, payload in records(file, partition.path.endswith(".gz"), self._wanted, self.payload):
                row = _columns(headers)
                if payload is not None and row["record_type"] != "revisit" and row["payload_digest"] not in (None, digest(payload)):
                    raise ValueError(f"{partition.path}: the payload of {row['record_id']} has another digest")
                rows.append((*row.values(), _payload_length(headers, payload), *([payload] if self.payload else [])))
                size += len(payload or b"") + 200
                if size >= BATCH_BYTES:
                    yield batch(rows)
                    rows, size = [], 0
        if rows:
            yield batch(rows)


class Written(WriterCommitMessage):
    def __init__(self, names: list[str]):
        self.names = names


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, path = _file_system(self.path)
        system.create_dir(path)
        names, out, size = [], None, 0
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is None:
                        names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        out, size = system.open_output_stream(f"{path}/{names[-1]}", compression=None), 0
                    data = member(record(row))
                    out.write(data)
                    size += len(data)
                    if size >= FILE_BYTES:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        system, path = _file_system(self.path)
        system.create_dir(path)
        with system.open_output_stream(f"{path}/_committed-{uuid.uuid4().hex}.json", compression=None) as out:
            out.write(json.dumps([n for m in messages if m is not None for n in m.names]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        system, path = _file_system(self.path)
        for m in messages:
            for name in m.names if m is not None else ():
                system.delete_file(f"{path}/{name}")


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def _payload(self) -> bool:
        return str(self.options.get("payload", "true")).lower() != "false"

    def schema(self) -> str:
        return f"{COLUMNS}, payload_length long" + ", payload binary" * self._payload()

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self._payload())

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only appended to: use mode('append')")
        return WarcWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    """Make format ``warc`` known to a session, with filter pushdown."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not import this module
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of a WARC file or of a folder of them. An empty folder gives no rows."""
    register(spark)
    return spark.read.format("warc").option("path", path).option("payload", str(payload).lower()).load()


def write_pages(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write a record for every row: of rows with equal payloads of at least ``least_bytes``
    bytes a response for the smallest id and revisits of it for the others.

    A null html is an empty payload, a null url has no header. Rows repeated with one id are
    all responses if it is the smallest. Rows with a null id are all responses.
    """
    register(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload")).withColumn("sha", F.sha1("payload"))
    # Only ids and hashes are shuffled here; hot payloads are pre-aggregated.
    narrow = common.settle(rows.where((F.length("payload") >= least_bytes) & F.col("id").isNotNull()).select("id", "sha"), "warc-hashes")
    shared = common.settle(narrow.groupBy("sha").agg(F.min("id").alias("first"), F.max("id").alias("last"))
                           .where("first <> last").select("sha", "first"), "warc-shared")
    again = common.settle(common.join_counted(narrow, shared, "sha", "inner", shared.count())
                          .where("id <> first").select("id", "sha", "first").distinct(), "warc-revisits")
    out = common.join_counted(rows, again, ["id", "sha"], "left", again.count())
    out.select(F.when(F.col("first").isNull(), "response").otherwise("revisit").alias("record_type"),
               F.format_string("<urn:page:%s>", F.coalesce(F.col("id").cast("string"), F.lit(""))).alias("record_id"),
               F.col("url").alias("target_uri"), F.lit(date).alias("date"),
               F.when(F.col("first").isNotNull(), F.format_string("<urn:page:%s>", F.col("first").cast("string"))).alias("refers_to"),
               "payload").write.format("warc").option("path", path).mode("append").save()


def _id(column: str):
    return F.regexp_extract(column, "^<urn:page:(.*)>$", 1)


def op10_warc(spark, sf_dir: str) -> DataFrame:
    """Writes all pages as archives, reads them back: page_id, payload_bytes,
    payload_digest, record_type, refers_to. Payloads are decoded for responses only."""
    path = common.shared_path(spark, "warc")
    write_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    parts = [read_warc(spark, path).where("record_type = 'response'").withColumn("payload_bytes", F.length("payload").cast("long")),
             read_warc(spark, path, payload=False).where("record_type = 'revisit'").withColumnRenamed("payload_length", "payload_bytes")]
    columns = [_id("record_id").try_cast("long").alias("page_id"), F.col("payload_bytes"), F.col("payload_digest"), F.col("record_type"),
               F.when(F.col("refers_to").isNotNull(), _id("refers_to").try_cast("long")).alias("refers_to")]
    return parts[0].select(*columns).union(parts[1].select(*columns))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h,
  min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (((('0x' || substr(h, (1 + 5 * (k // 4))::INT, 5))::INT >> (15 - 5 * (k % 4))::INT) & 31)), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM p
"""
