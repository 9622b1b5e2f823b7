"""WARC archives as a PySpark data source, ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Reading plans one task for each group of files of a bounded size. Predicates on
record type, page id, target address, digest and length are tested on the
headers, which are parsed first; the block of a record that fails, or whose
payload nobody asked for, is passed over without decoding it. Archives are
written one per task, a gzip member per record; a task that fails leaves only a
name that no reader lists, and the commit gives the names that readers see.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, WriterCommitMessage

from tidemerge.operators.spread import spread_join

SCHEMA = "record_type string, page_id long, url string, payload_bytes long, payload_digest string, refers_to long, payload binary"
READ_SIZE, PLAN_BYTES, BATCH_BYTES = 1 << 16, 64 << 20, 8 << 20
#: What is looked at of a gzip header.
LONGEST_HEAD = 1 << 10
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page: int | None, number: object = "") -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page {page} {number}')}>"


def address(url: str | None) -> str:
    """A header holds one line of ASCII: anything else is written by per cent signs."""
    return "".join(c if " " < c <= "~" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in url or "")


def record(kind: str, page: int | None, url: str | None, payload: bytes, size: int, sha1: str, refers_to: int | None) -> bytes:
    """One record; the block of a revisit is the HTTP header alone, with the size and digest of the payload it stands for."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page)}", f"WARC-Date: {DATE}"]
    head += [f"WARC-Target-URI: {address(url)}"] if url is not None else []
    head += [f"WARC-Payload-Digest: sha1:{sha1}", f"X-Payload-Length: {size}"]
    head += [f"X-Page-ID: {page}"] if page is not None else []
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode("ascii") + block + b"\r\n\r\n"


#: Names the extra field of a gzip header that holds the length of its member.
LENGTH = b"TM"


def gzipped(data: bytes, level: int = 1) -> bytes:
    """A gzip member that states its own length, so a reader can pass over it without unpacking."""
    maker = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = maker.compress(data) + maker.flush()
    extra = LENGTH + struct.pack("<HQ", 8, 12 + 12 + len(body) + 8)
    head = b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def member_length(head: bytes) -> int | None:
    """The length that the start of a gzip member states, if it does."""
    if len(head) < 12 or head[:3] != b"\x1f\x8b\x08" or not head[3] & 4:
        return None
    extra, at = head[12 : 12 + int.from_bytes(head[10:12], "little")], 0
    while at + 4 <= len(extra):
        name, size = extra[at : at + 2], int.from_bytes(extra[at + 2 : at + 4], "little")
        if name == LENGTH and size == 8:
            return int.from_bytes(extra[at + 4 : at + 12], "little")
        at += 4 + size
    return None


class Plain:
    """Records of an archive that is not compressed: a block is passed over by seeking."""

    def __init__(self, file: BinaryIO) -> None:
        self.file, self.held = file, b""

    def head(self) -> bytes | None:
        while True:
            self.held = self.held.lstrip(b"\r\n")  # what ends the record before
            end = self.held.find(b"\r\n\r\n")
            if end >= 0:
                break
            more = self.file.read(READ_SIZE)
            if not more:
                if self.held:
                    raise ValueError("archive ends within a header")
                return None
            self.held += more
        head, self.held = self.held[:end], self.held[end + 4 :]
        return head

    def block(self, n: int, wanted: bool) -> bytes | None:
        if not wanted:
            if n > len(self.held):
                self.file.seek(n - len(self.held), 1)
            self.held = self.held[n:]
            return None
        parts, got = [self.held], len(self.held)
        while got < n:
            more = self.file.read(max(READ_SIZE, n - got))
            if not more:
                raise ValueError("archive ends within a record")
            parts.append(more)
            got += len(more)
        data = b"".join(parts)
        self.held = data[n:]
        return data[:n]


class Members:
    """Records of an archive of one gzip member each: headers are unpacked first. The rest of an unwanted member is passed over by its stated length; where it states none, it runs through in small pieces, none kept."""

    def __init__(self, file: BinaryIO) -> None:
        self.file, self.raw, self.out, self.unpack, self.end = file, b"", b"", None, None

    def _more(self, room: int) -> bytes:
        """Up to ``room`` bytes of the member, b'' at its end."""
        while not self.unpack.eof:
            if not self.raw:
                self.raw = self.file.read(READ_SIZE)
                if not self.raw:
                    raise ValueError("archive ends within a record")
            data = self.unpack.decompress(self.raw, room)
            self.raw = self.unpack.unused_data if self.unpack.eof else self.unpack.unconsumed_tail
            if data:
                return data
        return b""

    def head(self) -> bytes | None:
        if self.unpack is not None:
            while self._more(READ_SIZE):
                pass
        if len(self.raw) < LONGEST_HEAD:
            self.raw += self.file.read(READ_SIZE)
        if not self.raw:
            return None
        length = member_length(self.raw[:LONGEST_HEAD])
        self.end = None if length is None else self.file.tell() - len(self.raw) + length
        self.unpack, self.out = zlib.decompressobj(31), b""
        while (end := self.out.find(b"\r\n\r\n")) < 0:
            more = self._more(1024)
            if not more:
                raise ValueError("record without header")
            self.out += more
        head, self.out = self.out[:end], self.out[end + 4 :]
        return head

    def block(self, n: int, wanted: bool) -> bytes | None:
        if not wanted:
            if self.end is not None:
                ahead = self.end - (self.file.tell() - len(self.raw))
                if ahead > len(self.raw):
                    self.file.seek(self.end)
                self.raw, self.unpack = self.raw[max(0, ahead) :], None
            return None
        parts, got = [self.out], len(self.out)
        while got < n and (more := self._more(n - got)):
            parts.append(more)
            got += len(more)
        return b"".join(parts)[:n]


def fields(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])}


def number(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch(r"-?[0-9]+", text) else None


def columns_of(head: dict[str, str]) -> dict[str, object]:
    """The columns that headers alone give."""
    return {
        "record_type": head.get("warc-type"),
        "page_id": number(head.get("x-page-id")),
        "url": head.get("warc-target-uri"),
        "payload_bytes": number(head.get("x-payload-length")),
        "payload_digest": (d[5:] if (d := head.get("warc-payload-digest")) and d.startswith("sha1:") else None),
        "refers_to": number(head.get("x-refers-to-page-id")),
    }


#: A predicate on one column as (column, test name, value); tests hold of no null but the last two.
TESTS = {
    "=": lambda a, b: a is not None and a == b,
    "<=>": lambda a, b: a == b,
    ">": lambda a, b: a is not None and a > b,
    ">=": lambda a, b: a is not None and a >= b,
    "<": lambda a, b: a is not None and a < b,
    "<=": lambda a, b: a is not None and a <= b,
    "in": lambda a, b: a is not None and a in b,
    "null": lambda a, b: a is None,
    "not null": lambda a, b: a is not None,
}
FILTERS = {EqualTo: "=", EqualNullSafe: "<=>", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<=", In: "in", IsNull: "null", IsNotNull: "not null"}


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]


class WarcReader(DataSourceReader):
    """Options: ``path``; ``payload``: ``bytes`` returns payloads, ``digest`` decodes them only to give their true size and digest, ``none`` (the default) leaves them alone; ``partitionBytes``."""

    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.payload = options["path"], options.get("payload", "none")
        self.most, self.tests = int(options.get("partitionBytes", PLAN_BYTES)), []
        if self.payload not in ("none", "digest", "bytes"):
            raise ValueError(f"payload is {self.payload!r}, not none, digest or bytes")

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            name = FILTERS.get(type(f))
            if name and len(f.attribute) == 1 and f.attribute[0] != "payload":
                value = tuple(f.value) if name == "in" else getattr(f, "value", None)
                self.tests.append((f.attribute[0], name, value))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        """Groups of files up to ``partitionBytes``; a file is the smallest unit, so writers close files in time."""
        store, root = fs.FileSystem.from_uri(self.path)
        found = store.get_file_info(fs.FileSelector(root, recursive=True)) if store.get_file_info(root).type == fs.FileType.Directory else [store.get_file_info(root)]
        found = sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and re.search(r"\.warc(\.gz)?$", f.path))
        groups, held = [[]], 0
        for path, size in found:
            if groups[-1] and held + size > self.most:
                groups.append([])
                held = 0
            groups[-1].append(path)
            held += size
        return [Files(tuple(g)) for g in groups]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(self.path)
        rows, held = [], 0
        for path in partition.paths:
            with store.open_input_file(path) as file:
                for row in self._rows((Members if path.endswith(".gz") else Plain)(file)):
                    rows.append(row)
                    held += 200 + len(row["payload"] or b"")
                    if held >= BATCH_BYTES:
                        yield batch_of(rows)
                        rows, held = [], 0
        if rows:
            yield batch_of(rows)

    def _rows(self, source: Plain | Members) -> Iterator[dict]:
        while (head := source.head()) is not None:
            head = fields(head)
            row, size = columns_of(head), int(head["content-length"])
            fits = all(self._holds(row, test) for test in self.tests if not self._late(row, test))
            wanted = fits and self.payload != "none" and row["record_type"] == "response"
            block = source.block(size, wanted)
            if not fits:
                continue
            row["payload"] = None
            if wanted:
                payload = block.partition(b"\r\n\r\n")[2]
                row["payload_bytes"], row["payload_digest"] = len(payload), digest(payload)
                if self.payload == "bytes":
                    row["payload"] = payload
            if all(self._holds(row, test) for test in self.tests):
                yield row

    def _late(self, row: dict, test: tuple) -> bool:
        """Whether the payload decides the test: its size and digest are those read, not those stated."""
        return self.payload != "none" and row["record_type"] == "response" and test[0] in ("payload_bytes", "payload_digest")

    def _holds(self, row: dict, test: tuple) -> bool:
        return TESTS[test[1]](row[test[0]], test[2])


TYPES = pa.schema([("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def batch_of(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, TYPES)


@dataclass
class Written(WriterCommitMessage):
    paths: tuple[str, ...]


class WarcWriter(DataSourceArrowWriter):
    """Rows of ``SCHEMA``, whose digest may also be 40 hexadecimal digits; option ``fileBytes``: a task starts another file beyond so many bytes."""

    def __init__(self, options: dict[str, str], overwrite: bool) -> None:
        if overwrite:
            raise ValueError("archives are appended to; write to a new folder")
        self.path, self.most = options["path"], int(options.get("fileBytes", PLAN_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        paths, file, size = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if file is None:
                    paths.append(f"{root}/{uuid.uuid4()}.open")
                    file, size = store.open_output_stream(paths[-1]), 0
                    info = b"software: tidemerge\r\nformat: WARC File Format 1.1\r\n"
                    head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: {record_id(None, paths[-1])}\r\nWARC-Date: {DATE}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n"
                    file.write(gzipped(head.encode() + info + b"\r\n\r\n"))
                sha1 = row["payload_digest"]
                if len(sha1) == 40:
                    sha1 = base64.b32encode(bytes.fromhex(sha1)).decode()
                data = gzipped(record(row["record_type"], row["page_id"], row["url"], row["payload"] or b"", row["payload_bytes"], sha1, row["refers_to"]))
                file.write(data)
                size += len(data)
                if size >= self.most:
                    file.close()
                    file = None
        if file is not None:
            file.close()
        return Written(tuple(paths))

    def commit(self, messages: list[Written | None]) -> None:
        store, _ = fs.FileSystem.from_uri(self.path)
        for message in messages:
            for path in message.paths if message else ():
                store.move(path, path.removesuffix(".open") + ".warc.gz")

    def abort(self, messages: list[Written | None]) -> None:
        store, _ = fs.FileSystem.from_uri(self.path)
        for message in messages:
            for path in message.paths if message else ():
                store.delete_file(path)


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def write_archives(pages: DataFrame, path: str, least: int = 0) -> None:
    """A record for every row of (page_id, url, html) into new archives at ``path``.

    Of rows with equal payloads of at least ``least`` bytes, those with the
    largest page_id are responses and the others revisit it; smaller payloads
    are responses all. A null html is empty. Rows that repeat the largest
    page_id are responses each; a null page_id is smaller than any, and where
    all of a group are null all are responses. Payloads are compared by size and
    SHA-1; only digests meet in the aggregation. Other columns are not looked at.
    An empty table writes no file.
    """
    spark = pages.sparkSession
    register(spark)
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("sha", F.sha1("payload"))
    last = rows.where(F.col("payload_bytes") >= least).groupBy("payload_bytes", "sha").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1").drop("n")
    # pages move to their partner once, unless the list of repeated payloads is small enough for Spark to broadcast; a very common payload is spread
    rows = spread_join(rows, last, ["sha", "payload_bytes"], spread_by=["page_id"])
    again = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    out = rows.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"), "page_id", "url", "payload_bytes",
        F.col("sha").alias("payload_digest"), F.when(again, F.col("last")).alias("refers_to"),
        F.when(~again, F.col("payload")).alias("payload"),
    )
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "1000")
    try:
        out.write.format("warc").mode("append").save(path)
    finally:
        spark.conf.set(setting, before)


def read_archives(spark, path: str, payload: str = "none") -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("path", path).option("payload", payload).load()


def archived_pages(pages: DataFrame, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record of ``pages``, read back from archives in ``folder``; sizes and digests of responses are those of the payloads read."""
    path = f"{folder.rstrip('/')}/warc-{uuid.uuid4()}"
    write_archives(pages, path)
    back = read_archives(pages.sparkSession, path, payload="digest").where(F.col("record_type").isin("response", "revisit"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
