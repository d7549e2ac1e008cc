"""WARC archives as a PySpark data source.

Writing: each task writes one gzip file with one member for each record, under a name that only the
commit makes visible. A member says its length in the ``sl`` field of its header, so a reader
steps over a record without inflating it.

Reading: the driver lists the files and plans partitions of about ``splitBytes``; small files go
together, and large ones are cut and each cut reads on from the first member that begins behind it.
Record type and header predicates are pushed down. A record's headers are inflated first, a few
hundred bytes; a record that the predicates turn down, or whose payload the schema does not ask
for, is not inflated further. Members without ``sl`` and plain files can be read too, plain ones uncut.
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

import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualNullSafe,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

SPLIT_BYTES = 64 << 20
#: Bytes inflated to find the end of the headers, as often as needed.
HEADER_BYTES = 4096
READ_BYTES = 1 << 16
LEVEL = 4
DATE = "1970-01-01T00:00:00Z"

#: Columns that are header fields.
HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "date": "WARC-Date",
    "target_uri": "WARC-Target-URI",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "content_type": "Content-Type",
    "content_length": "Content-Length",
}
SCHEMA = (
    "record_id string, record_type string, date string, target_uri string, refers_to string,"
    " payload_digest string, content_type string, content_length long, payload_length long, payload binary"
)
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def file_system(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a folder that every executor reaches, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(path)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _escaped(value: str) -> str:
    """A header value on one line: control signs and white space as percent codes."""
    return re.sub("[\\x00-\\x20\\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record_bytes(row: dict) -> bytes:
    """One record; a revisit has the HTTP headers of its payload, and no payload."""
    payload = bytes(row["payload"] or b"")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if row["record_type"] == "revisit" else http + payload
    fields = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", f"<{_escaped(row['record_id'])}>"),
        ("WARC-Date", row.get("date") or DATE),
        ("WARC-Target-URI", row["target_uri"]),
        ("WARC-Refers-To", row["refers_to"] and f"<{_escaped(row['refers_to'])}>"),
        ("WARC-Profile", _REVISIT if row["record_type"] == "revisit" else None),
        ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "".join(f"{name}: {_escaped(value) if name == 'WARC-Target-URI' else value}\r\n" for name, value in fields if value is not None)
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def member(data: bytes, level: int = LEVEL) -> bytes:
    """One gzip member with its own length and that of its data in the ``sl`` field."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    length = 24 + len(body) + 8
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, length, len(data) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


@dataclass
class _Written(WriterCommitMessage):
    name: str
    records: int


class WarcWriter(DataSourceWriter):
    def __init__(self, path: str, schema, overwrite: bool) -> None:
        self.path, self.columns, self.overwrite = path, schema.names, overwrite

    def write(self, rows: Iterator) -> _Written:
        files, path = file_system(self.path)
        name = f"part-{uuid.uuid4().hex}.warc.gz"
        files.create_dir(f"{path}/_temporary", recursive=True)
        count = 0
        with files.open_output_stream(f"{path}/_temporary/{name}", compression=None) as out:
            for row in rows:
                found = row.asDict()
                out.write(member(record_bytes({c: found.get(c) for c in ("record_type", "record_id", "date", "target_uri", "refers_to", "payload")})))
                count += 1
        return _Written(name, count)

    def commit(self, messages: list[_Written | None]) -> None:
        """Only the files of tasks that ended well become visible."""
        files, path = file_system(self.path)
        files.create_dir(path, recursive=True)
        if self.overwrite:
            for info in _listed(files, path):
                files.delete_file(info.path)
        for message in messages:
            if message is not None:
                source = f"{path}/_temporary/{message.name}"
                if message.records:
                    files.move(source, f"{path}/{message.name}")
                else:
                    files.delete_file(source)

    def abort(self, messages: list[_Written | None]) -> None:
        files, path = file_system(self.path)
        for message in messages:
            if message is not None:
                files.delete_file(f"{path}/_temporary/{message.name}")


def _listed(files: pyarrow.fs.FileSystem, path: str) -> list[pyarrow.fs.FileInfo]:
    found = files.get_file_info(pyarrow.fs.FileSelector(path, allow_not_found=True))
    found = [f for f in found if f.type == pyarrow.fs.FileType.File and f.base_name[0] not in "._"]
    return sorted(found, key=lambda f: f.path)


@dataclass
class Cuts(InputPartition):
    """Ranges ``(file, start, end)`` of one partition: the members that begin in a range belong to it."""

    ranges: list[tuple[str, int, int]]


class _Stream:
    """Buffered reads of a file from any place."""

    def __init__(self, handle) -> None:
        self.handle, self.at, self.data = handle, 0, b""

    def read(self, at: int, size: int) -> bytes:
        if not self.at <= at or at + size > self.at + len(self.data):
            self.handle.seek(at)
            self.at, self.data = at, self.handle.read(max(size, READ_BYTES))
        return self.data[at - self.at : at - self.at + size]


class _Member:
    """One gzip member, inflated only as far as it is asked for."""

    def __init__(self, stream: _Stream, at: int) -> None:
        self.stream, self.start, self.at = stream, at, at
        self.inflate, self.data = zlib.decompressobj(31), b""

    def upto(self, size: int) -> bytes:
        while len(self.data) < size and not self.inflate.eof:
            raw = self.inflate.unconsumed_tail
            if not raw:
                raw = self.stream.read(self.at, READ_BYTES)
                if not raw:
                    raise EOFError(f"member at {self.start} is cut off")
                self.at += len(raw)
            self.data += self.inflate.decompress(raw, max(1, size - len(self.data)))
        return self.data

    def length(self) -> int:
        """Its bytes in the file: from ``sl``, or else by inflating what is left, keeping none of it."""
        head = self.stream.read(self.start, 24)
        if len(head) == 24 and head[3] == 4 and head[12:14] == b"sl":
            return struct.unpack("<I", head[16:20])[0]
        while not self.inflate.eof:
            raw = self.inflate.unconsumed_tail or self.stream.read(self.at, READ_BYTES)
            if not raw:
                raise EOFError(f"member at {self.start} is cut off")
            if not self.inflate.unconsumed_tail:
                self.at += len(raw)
            self.inflate.decompress(raw, READ_BYTES)
        return self.at - len(self.inflate.unused_data) - self.start


class _Plain:
    """One record of a file that is not compressed."""

    def __init__(self, stream: _Stream, at: int) -> None:
        self.stream, self.start = stream, at

    def upto(self, size: int) -> bytes:
        return self.stream.read(self.start, size)


def _headers(text: bytes) -> dict[str, str]:
    found: dict[str, str] = {}
    name = ""
    for line in text.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            found[name] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            found[name] = value.strip()
    return found


def _head(record, marker: bytes = b"\r\n\r\n", after: int = 0) -> int:
    """Where the headers that begin at ``after`` end."""
    size = after + HEADER_BYTES
    while True:
        data = record.upto(size)
        if (end := data.find(marker, after)) >= 0:
            return end + len(marker)
        if len(data) < size:
            return -1
        size *= 2


def _value(headers: dict[str, str], column: str):
    value = headers.get(HEADERS[column].lower())
    if value is None:
        return None
    if column in ("record_id", "refers_to"):
        return value.removeprefix("<").removesuffix(">")
    return int(value) if column == "content_length" else value


def _accepts(condition: Filter, headers: dict[str, str]) -> bool:
    if isinstance(condition, Not):
        column = condition.child.attribute[0]
        return _value(headers, column) is not None and not _accepts(condition.child, headers)
    value = _value(headers, condition.attribute[0])
    if isinstance(condition, IsNull):
        return value is None
    if isinstance(condition, EqualNullSafe):
        return value == condition.value
    if value is None:
        return False
    if isinstance(condition, IsNotNull):
        return True
    if isinstance(condition, EqualTo):
        return value == condition.value
    if isinstance(condition, In):
        return value in condition.value
    if isinstance(condition, StringStartsWith):
        return value.startswith(condition.value)
    if isinstance(condition, StringEndsWith):
        return value.endswith(condition.value)
    return condition.value in value


_PUSHED = (EqualTo, EqualNullSafe, In, IsNotNull, IsNull, StringStartsWith, StringEndsWith, StringContains)
_NEGATED = (EqualTo, In, StringStartsWith, StringEndsWith, StringContains)


class WarcReader(DataSourceReader):
    def __init__(self, path: str, columns: list[str], split_bytes: int) -> None:
        self.path, self.columns, self.split_bytes, self.conditions = path, columns, split_bytes, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for condition in filters:
            inner = condition.child if isinstance(condition, Not) else condition
            kinds = _NEGATED if isinstance(condition, Not) else _PUSHED
            if isinstance(inner, kinds) and len(inner.attribute) == 1 and inner.attribute[0] in HEADERS:
                self.conditions.append(condition)
            else:
                yield condition

    def partitions(self) -> list[Cuts]:
        files, path = file_system(self.path)
        planned, together, size = [], [], 0
        for info in _listed(files, path):
            if info.size > self.split_bytes and info.base_name.endswith(".gz"):
                starts = range(0, info.size, self.split_bytes)
                planned += [Cuts([(info.path, at, min(at + self.split_bytes, info.size))]) for at in starts]
                continue
            if together and size + info.size > self.split_bytes:
                planned.append(Cuts(together))
                together, size = [], 0
            together.append((info.path, 0, info.size))
            size += info.size
        return [*planned, Cuts(together)]

    def read(self, partition: Cuts) -> Iterator[tuple]:
        files, _ = file_system(self.path)
        for path, start, end in partition.ranges:
            with files.open_input_file(path) as handle:
                yield from self.records(_Stream(handle), start, end)

    def records(self, stream: _Stream, start: int, end: int) -> Iterator[tuple]:
        packed = stream.read(0, 2) == b"\x1f\x8b"
        at = _first_member(stream, start, end) if start else start
        wants = "payload" in self.columns
        while at < end:
            record = _Member(stream, at) if packed else _Plain(stream, at)
            stop = _head(record)
            if stop < 0:
                break
            headers = _headers(record.upto(stop)[:stop])
            length = int(headers.get("content-length", 0))
            if all(_accepts(condition, headers) for condition in self.conditions):
                yield self.row(record, headers, stop, length, wants)
            at += record.length() if packed else stop + length + 4

    def row(self, record, headers: dict[str, str], stop: int, length: int, wants: bool) -> tuple:
        inner, payload = None, None
        is_http = headers.get("content-type", "").startswith("application/http")
        begin = _head(record, after=stop) if is_http and ("payload_length" in self.columns or wants) else stop
        if is_http and begin > stop:
            text = record.upto(begin)[stop:begin]
            inner = _headers(text).get("content-length")
        if wants and headers.get("warc-type") != "revisit":
            payload = bytes(record.upto(stop + length)[max(begin, stop) : stop + length])
        sizes = {"payload": payload, "payload_length": int(inner) if inner and inner.isdigit() else length - max(0, begin - stop)}
        return tuple(sizes[c] if c in sizes else _value(headers, c) for c in self.columns)


def _first_member(stream: _Stream, start: int, end: int) -> int:
    """The first member that begins in ``start`` to ``end``, or ``end``; a match must inflate to a record."""
    at = start
    while at < end:
        window = stream.read(at, READ_BYTES)
        found = window.find(b"\x1f\x8b\x08")
        if found < 0:
            if len(window) < 3:
                return end
            at += max(1, len(window) - 2)
            continue
        at += found
        if at >= end:
            return end
        try:
            if _Member(stream, at).upto(5) == b"WARC/":
                return at
        except (zlib.error, EOFError):
            pass
        at += 1
    return end


class WarcSource(DataSource):
    """``spark.read.format("warc")`` and ``df.write.format("warc")`` over a folder of archives."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        unknown = set(schema.names) - {*HEADERS, "payload", "payload_length"}
        if unknown:
            raise ValueError(f"not a column of a WARC record: {', '.join(sorted(unknown))}")
        return WarcReader(self.options["path"], schema.names, int(self.options.get("splitbytes", SPLIT_BYTES)))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], schema, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to a session and let it push predicates to Python."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write_pages(pages: DataFrame, path: str) -> None:
    """A record for each row of ``pages`` (``page_id, url, html``) into the folder ``path``.

    Of rows with equal payloads that with the smallest page_id is a response and the others
    revisit it. A row without an id revisits one that has one; rows that repeat the smallest id are responses too.
    A null html is an empty payload, a null url is left out. Other columns are not read, and an
    empty table gives an empty folder.
    """
    register(pages.sparkSession)
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select("page_id", F.col("url").cast("string").alias("target_uri"), payload.alias("payload"), F.sha1(payload).alias("digest"))
    ids = rows.select("page_id", "digest")
    firsts = ids.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1 AND first_id IS NOT NULL")
    # Hot payloads meet here as digests only; pages themselves are joined by their own id.
    again = (
        ids.join(firsts, "digest").where("NOT (page_id <=> first_id)").select(F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), "first_id").distinct()
    )
    joined = rows.join(again, F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left")
    joined.select(
        F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit(""))).alias("record_id"),
        F.when(F.col("first_id").isNull(), "response").otherwise("revisit").alias("record_type"),
        "target_uri",
        F.concat(F.lit("urn:page:"), F.col("first_id").cast("string")).alias("refers_to"),
        "payload",
    ).write.format("warc").mode("append").save(path)


def read_pages(spark: SparkSession, path: str, types: tuple[str, ...] = ("response", "revisit")) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of the records of these types."""
    register(spark)
    columns = "record_id string, record_type string, refers_to string, payload_digest string, payload_length long"
    records = spark.read.format("warc").schema(columns).load(path).where(F.col("record_type").isin(*types))
    number = lambda c: F.nullif(F.expr(f"substring({c}, length('urn:page:') + 1)"), F.lit("")).cast("long")
    return records.select(
        number("record_id").alias("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        F.expr("substring(payload_digest, length('sha1:') + 1)").alias("payload_digest"),
        "record_type",
        number("refers_to").alias("refers_to"),
    )
