"""WARC archives as a PySpark data source, for reading and writing.

Files hold one gzip member per record.  Each member names its own compressed
length in the ``sl`` extra field, so that a reader inflates the headers of a
record first, tests the pushed predicates on them and seeks past the rest of
a record it does not want.  Archives without that field, with any number of
records in a member, and plain ``.warc`` files are read too; a record without
headers is an error.  Every write ends with a manifest of its own, moved into
place whole: it lists the write's files and places in them where a reader may
start, so long files are read by many tasks.  Readers take the union of all
manifests since the last overwrite; files of failed or repeated tasks are in
none and never read.  The first write into a folder lists the foreign archives
that it finds there, so they stay visible.

Defined cases: a null payload is empty; a null address leaves its header out;
line breaks in header values are percent-encoded; records of any length are
read, one in memory at a time; an empty folder or table gives no rows.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, In, InputPartition, IsNotNull, IsNull, StringStartsWith, WriterCommitMessage,
)

from tributary.session import settled, ship_package, work_dir

SCHEMA = (
    "record_type string, record_id string, target_uri string, record_date string, payload_digest string, refers_to string,"
    " content_length bigint, http_length bigint, payload binary"
)
# fixed values: header names of the archive format
HEADER_OF = {
    "record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "record_date": "warc-date",
    "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to",
}
MANIFEST = "_manifest-"
OWN = re.compile(r"pages-[0-9a-f]{32}-[0-9]+-[0-9]+\.warc\.gz")  # what a write of this module names its files
ARCHIVES = (".warc", ".warc.gz")
START_BYTES = 8 << 20  # a reader may start about this often in a file
WINDOW = 1 << 20
ROWS_PER_BATCH, BYTES_PER_BATCH = 2000, 16 << 20
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEAST_REVISIT_BYTES = 100


def folder(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path and the path on it, for any scheme that Arrow knows."""
    return pafs.FileSystem.from_uri(path)


def member(record: bytes) -> bytes:
    """One gzip member that names its compressed and plain length."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    tail = struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    size = 12 + 12 + len(body) + 8
    if size >= 1 << 32 or len(record) >= 1 << 32:  # too long for the field: the reader inflates such a member
        return b"\x1f\x8b\x08\x00" + bytes(5) + b"\xff" + body + tail
    extra = b"sl" + struct.pack("<HII", 8, size, len(record))
    return b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff" + struct.pack("<H", len(extra)) + extra + body + tail


def clean(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record_bytes(row: dict) -> bytes:
    payload = row["payload"] or b""
    revisit = row["record_type"] == "revisit"
    length = row["http_length"] if row["http_length"] is not None else len(payload)
    http = row["record_type"] in ("response", "revisit")
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode() if http else b""
    if not revisit:
        block += payload
    head = ["WARC/1.1"]
    for column, name in (
        ("record_type", "WARC-Type"), ("record_id", "WARC-Record-ID"), ("record_date", "WARC-Date"), ("target_uri", "WARC-Target-URI"),
        ("payload_digest", "WARC-Payload-Digest"), ("refers_to", "WARC-Refers-To"),
    ):
        if row[column] is not None:
            head.append(f"{name}: {clean(row[column])}")
    if revisit:
        head.append(f"WARC-Profile: {REVISIT_PROFILE}")
    head += [f"Content-Type: {'application/http; msgtype=response' if http else 'application/octet-stream'}", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class Written(WriterCommitMessage):
    files: list  # of {"name", "starts": places of some members}


def listing(fs: pafs.FileSystem, base: str) -> dict[str, int]:
    """Names and sizes of the files of a folder, which need not be there."""
    found = fs.get_file_info(pafs.FileSelector(base, recursive=False, allow_not_found=True))
    return {f.base_name: f.size for f in found if f.type == pafs.FileType.File}


def visible(fs: pafs.FileSystem, base: str, names: Iterable[str]) -> list[dict]:
    """Files of the manifests among ``names``, from the last overwrite on, or all archives if there is none."""
    manifests = sorted(n for n in names if n.startswith(MANIFEST) and n.endswith(".json"))
    if not manifests:
        return [{"name": n, "starts": [0]} for n in sorted(names) if n.endswith(ARCHIVES) and not OWN.fullmatch(n)]
    files: list[dict] = []
    for name in manifests:
        with fs.open_input_stream(f"{base}/{name}", compression=None) as handle:
            manifest = json.loads(handle.read())
        files = manifest["files"] if manifest["overwrite"] else files + manifest["files"]
    return files


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, file_bytes: int, overwrite: bool = False):
        self.path, self.file_bytes, self.overwrite = path, file_bytes, overwrite
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, base = folder(self.path)
        fs.create_dir(base, recursive=True)
        context, files, out, size = TaskContext.get(), [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    # a repeated attempt of a task has names of its own
                    files.append({"name": f"pages-{self.job}-{context.taskAttemptId()}-{len(files)}.warc.gz", "starts": [0]})
                    out, size = fs.open_output_stream(f"{base}/{files[-1]['name']}", compression=None), 0
                if size - files[-1]["starts"][-1] >= START_BYTES:
                    files[-1]["starts"].append(size)
                packed = member(record_bytes(row))
                out.write(packed)
                size += len(packed)
                if size >= self.file_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages: list) -> None:
        fs, base = folder(self.path)
        fs.create_dir(base, recursive=True)
        before = listing(fs, base)
        manifests = [n for n in before if n.startswith(MANIFEST) and n.endswith(".json")]
        generation = 1 + max((int(n[len(MANIFEST) :].split("-")[0]) for n in manifests), default=0)
        files = sorted((f for m in messages if m for f in m.files), key=lambda f: f["name"])
        if not manifests and not self.overwrite:
            files = visible(fs, base, before) + files  # foreign archives
        old = {f["name"] for f in visible(fs, base, before)} if self.overwrite else set()
        name = f"{MANIFEST}{generation:010d}-{self.job}.json"
        with fs.open_output_stream(f"{base}/.{name}.part", compression=None) as out:
            out.write(json.dumps({"overwrite": self.overwrite, "files": files}).encode())
        fs.move(f"{base}/.{name}.part", f"{base}/{name}")
        if self.overwrite:  # nothing lists these any more
            for gone in [*sorted(old), *manifests]:
                fs.delete_file(f"{base}/{gone}")

    def abort(self, messages: list) -> None:
        """Nothing to undo: what no manifest lists is never read."""


@dataclass
class Files(InputPartition):
    pieces: tuple  # of (path, first byte, end byte or -1 for the file's end)


class Source:
    """Random access to a file through a moving window."""

    def __init__(self, handle):
        self.handle, self.size = handle, handle.size()
        self.at, self.held = 0, b""

    def read(self, offset: int, n: int) -> bytes:
        if offset < self.at or offset + n > self.at + len(self.held):
            self.handle.seek(offset)
            self.at, self.held = offset, self.handle.read(max(n, WINDOW))
        return self.held[offset - self.at : offset - self.at + n]


def header_fields(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


class Record:
    """One record: its headers now, its block on demand, then the place of the next."""

    def __init__(self, source: Source, offset: int, before: Record | None = None):
        """The record at ``offset``, or the one that follows ``before`` inside the same member."""
        self.source, self.offset, self.next = source, offset, None
        self.plain, self.at, self.sized = bytearray(), offset, False
        if before:
            self.zipped, self.inflater, self.plain, self.at, self.next = True, before.inflater, before.plain, before.at, before.next
        else:
            start = source.read(offset, 24)
            self.zipped = start[:2] == b"\x1f\x8b"
            if self.zipped:
                if start[3] == 4 and start[12:14] == b"sl":
                    self.next, self.sized = offset + struct.unpack_from("<I", start, 16)[0], True
                self.inflater = zlib.decompressobj(31)
        while (cut := self.plain.find(b"\r\n\r\n")) < 0 and self._more(4096):
            pass
        self.cut = cut + 4 if cut >= 0 else len(self.plain)
        self.headers = header_fields(bytes(self.plain[: self.cut]))
        self.length = int(self.headers.get("content-length", 0))
        if not self.zipped:
            self.next = offset + self.cut + self.length + 4

    def _more(self, n: int) -> bool:
        if self.at >= self.source.size or (self.zipped and self.inflater.eof):
            return False
        raw = self.source.read(self.at, min(n, self.source.size - self.at))
        self.at += len(raw)
        if self.zipped:
            self.plain += self.inflater.decompress(raw)
            if self.inflater.eof:
                self.next = self.at - len(self.inflater.unused_data)
        else:
            self.plain += raw
        return True

    def block(self) -> bytes:
        while len(self.plain) < self.cut + self.length and self._more(WINDOW):
            pass
        return bytes(self.plain[self.cut : self.cut + self.length])

    def after(self) -> Record | int:
        """The next record of the same member, or the place of the next member or record."""
        if not self.zipped or self.sized:
            return self.next
        left = self.cut + self.length
        while True:  # past the block, a window at a time, and past the line breaks behind it
            gone = min(left, len(self.plain))
            del self.plain[:gone]
            left -= gone
            if not left:
                while self.plain[:1] in (b"\r", b"\n"):
                    del self.plain[:1]
            if not left and self.plain:
                return Record(self.source, self.offset, self)
            if not self._more(WINDOW):
                return self.next if self.next is not None else self.source.size


def records(source: Source, start: int = 0, end: int = -1) -> Iterator[Record]:
    """Records of a file, or those that begin in a piece of it that starts at a member."""
    at: Record | int = start
    end = source.size if end < 0 else end
    while isinstance(at, Record) or at < end:
        record = at if isinstance(at, Record) else Record(source, at)
        if not record.headers:
            raise ValueError(f"a record without headers in the archive, at byte {record.offset}")
        yield record
        at = record.after()


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.payload = options["path"], options.get("payload", "true") == "true"
        self.part_bytes = int(options.get("maxpartitionbytes", 64 << 20))
        self.tests: list = []

    def pushFilters(self, filters: list) -> Iterator:
        """Take over equality, list, prefix and null tests on header columns."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in HEADER_OF and isinstance(f, (EqualTo, EqualNullSafe, In, StringStartsWith, IsNotNull, IsNull)):
                self.tests.append((HEADER_OF[column], type(f).__name__, getattr(f, "value", None)))
            else:
                yield f

    def partitions(self) -> list[Files]:
        """Pieces of long files and small files together, up to ``maxPartitionBytes``."""
        fs, base = folder(self.path)
        sizes = listing(fs, base)
        parts, held, total = [], [], 0
        for file in visible(fs, base, sizes):
            begin, size = 0, sizes[file["name"]]
            for start in [*file["starts"][1:], size]:
                if held and total + start - begin > self.part_bytes:
                    parts.append(Files(tuple(held)))
                    held, total = [], 0
                path = f"{base}/{file['name']}"
                if held and held[-1][0] == path:
                    held[-1] = (path, held[-1][1], start if start < size else -1)
                else:
                    held.append((path, begin, start if start < size else -1))
                total, begin = total + start - begin, start
        return [*parts, *([Files(tuple(held))] if held else [])] or [Files(())]

    def wanted(self, headers: dict[str, str]) -> bool:
        for name, kind, value in self.tests:
            have = headers.get(name)
            if kind == "IsNull":
                ok = have is None
            elif kind == "EqualNullSafe" and value is None:
                ok = have is None
            elif have is None:
                ok = False
            elif kind == "In":
                ok = have in value
            elif kind == "StringStartsWith":
                ok = have.startswith(value)
            else:
                ok = kind == "IsNotNull" or have == value
            if not ok:
                return False
        return True

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([(c, pa.string()) for c in HEADER_OF] + [("content_length", pa.int64()), ("http_length", pa.int64()), ("payload", pa.binary())])
        fs, _ = folder(self.path)
        rows, size = [], 0
        for path, start, end in partition.pieces:
            with fs.open_input_file(path) as handle:
                for record in records(Source(handle), start, end):
                    if not self.wanted(record.headers):
                        continue
                    row = {c: record.headers.get(h) for c, h in HEADER_OF.items()} | {"content_length": record.length}
                    if self.payload:
                        block = record.block()
                        cut = block.find(b"\r\n\r\n") if record.headers.get("content-type", "").startswith("application/http") else -4
                        row["payload"] = block[cut + 4 :]
                        size += len(block)
                        http = block[: max(cut, 0)]
                    else:
                        while b"\r\n\r\n" not in record.plain[record.cut :] and len(record.plain) < record.cut + record.length and record._more(4096):
                            pass
                        http = bytes(record.plain[record.cut :]).partition(b"\r\n\r\n")[0]
                    length = header_fields(http).get("content-length", "")
                    row["http_length"] = int(length) if length.isdigit() else None
                    rows.append(row)
                    if len(rows) >= ROWS_PER_BATCH or size >= BYTES_PER_BATCH:
                        yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=kinds)


class Warc(DataSource):
    """``spark.read.format("warc").load(path)``; ``payload=false`` leaves payloads undecoded and null."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader({k.lower(): v for k, v in self.options.items()})

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], int(self.options.get("filebytes", 1 << 30)), overwrite)


def register(spark: SparkSession) -> None:
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Warc)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def page_records(pages: DataFrame, least: int = LEAST_REVISIT_BYTES, date: dt.datetime = dt.datetime(2024, 1, 1)) -> DataFrame:
    """Pages (page_id, url, html) as archive records; equal long payloads revisit the smallest id's.

    Rows that repeat the response's id are responses too; null ids never are
    the response that others refer to unless all of a payload are null.
    """
    pages = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    pages = pages.withColumn("digest", F.sha2("payload", 256)).withColumn("http_length", F.octet_length("payload").cast("long"))
    long_ones = pages.where(F.col("http_length") >= least)
    repeated = settled(long_ones.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").drop("n"))
    joined = pages.join(repeated, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    return joined.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), urn("page_id").alias("record_id"), F.col("url").alias("target_uri"),
        F.lit(f"{date:%Y-%m-%dT%H:%M:%SZ}").alias("record_date"), F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        F.when(revisit, urn("first")).alias("refers_to"), F.lit(None).cast("long").alias("content_length"), "http_length",
        F.when(~revisit, F.col("payload")).alias("payload"))


def write_warc(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Add records to a folder, or ``overwrite`` all that are visible there."""
    register(rows.sparkSession)
    rows.write.format("warc").mode(mode).save(path)


def archived(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write the pages as archives and read them back: one row per page.

    Responses are digested anew from their payload; revisits are read without
    decoding any payload.
    """
    spark = pages.sparkSession
    path = path or work_dir(spark, "warc")
    write_warc(page_records(pages), path)
    number = lambda c: F.regexp_extract(c, "<urn:page:(-?[0-9]+)>", 1).try_cast("long")
    responses = read_warc(spark, path).where("record_type = 'response'").select(
        number("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"),
        "record_type", F.lit(None).cast("long").alias("refers_to"))
    revisits = read_warc(spark, path, payload=False).where("record_type = 'revisit'").select(
        number("record_id").alias("page_id"), F.col("http_length").alias("payload_bytes"), F.regexp_replace("payload_digest", "^sha256:", "").alias("payload_digest"),
        "record_type", number("refers_to").alias("refers_to"))
    return responses.unionByName(revisits)
