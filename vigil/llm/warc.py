"""WARC archives as a PySpark data source: ``spark.dataSource.register(WarcSource)``, then format ``warc``.

Reading. Partitions are byte ranges of the archives; a range takes the records that begin in it. Where records begin is read from
the offsets this writer leaves beside each archive: payloads may hold archives themselves, so the bytes alone cannot tell.
Archives without offsets, and uncompressed ``.warc`` files, are one range each. Headers are read first. Predicates on the record type and on other headers are taken
over from the plan (``spark.sql.python.filterPushdown.enabled``), and a record that fails them, or any record when the option
``payload`` is ``false``, is stepped over: archives of this writer name each member's length in an extra field of its gzip
header, so nothing behind the WARC header is unpacked. Archives of other writers are unpacked and thrown away instead.

Writing. Each task writes one archive, each record one gzip member, under a name of its own in a folder of the
job; only the files of committed tasks are moved to their place, so lost or repeated tasks leave no records and jobs do not meet.

Folders are URIs or paths that pyarrow opens. Defined results: a null URL leaves its header out, a null payload is empty,
control characters and spaces in a header value are percent-encoded; an empty table writes no records; a truncated or foreign record
raises an error.
"""

from __future__ import annotations

import base64
import bisect
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage

from vigil.llm.common import pages, stored
from vigil.session import intermediate_folder

SCHEMA = "record_id string, record_type string, target_uri string, date string, payload_digest string, payload_bytes bigint, refers_to string, payload binary"
#: Column, header
HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "payload_bytes": "X-Payload-Length",
    "refers_to": "WARC-Refers-To",
}
DATE = "2024-01-01T00:00:00Z"
RANGE = 64 << 20
MARK = 1 << 16
OFFSETS = ".offsets"
SMALLEST_SHARED = 1000
_BLOCK = 1 << 18


class _File:
    """Random access in aligned blocks, the last two kept."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        self.file = fs.open_input_file(path)
        self.size = self.file.size()
        self.blocks: dict[int, bytes] = {}

    def block(self, at: int) -> bytes:
        """What lies between ``at`` and the end of its block."""
        number = at // _BLOCK
        if number not in self.blocks:
            if len(self.blocks) > 1:
                self.blocks.pop(next(iter(self.blocks)))
            self.file.seek(number * _BLOCK)
            self.blocks[number] = self.file.read(_BLOCK)
        return self.blocks[number][at - number * _BLOCK :]

    def read(self, at: int, n: int) -> bytes:
        out = b""
        while n > len(out) and at + len(out) < self.size:
            out += self.block(at + len(out))[: n - len(out)]
        return out


class _Member:
    """A gzip member, unpacked as far as asked."""

    def __init__(self, file: _File, at: int):
        head = file.read(at, 12)
        if len(head) < 12 or head[:3] != b"\x1f\x8b\x08" or head[3] & 0xE0:
            raise ValueError(f"no gzip member of a WARC record at byte {at}")
        self.file, self.begin, self.length, self.data = file, at, 0, b""
        self.at = at + 10
        if head[3] & 4:
            (size,) = struct.unpack("<H", head[10:12])
            extra = file.read(at + 12, size)
            self.at = at + 12 + size
            while len(extra) >= 4:
                (n,) = struct.unpack("<H", extra[2:4])
                if extra[:2] == b"sl" and n == 8:
                    self.length = struct.unpack("<II", extra[4:12])[0]
                extra = extra[4 + n :]
        for _ in range(bool(head[3] & 8) + bool(head[3] & 16)):  # a name, a comment
            while (byte := file.read(self.at, 1)) != b"\0":
                if not byte:
                    raise ValueError(f"record at byte {at} is cut off")
                self.at += 1
            self.at += 1
        self.at += head[3] & 2  # a checksum of the header
        self.unpack = zlib.decompressobj(-15)

    def more(self, most: int = 0) -> bytes:
        if self.unpack.eof:
            return b""
        packed = self.unpack.unconsumed_tail
        if not packed:
            packed = self.file.block(self.at) if self.at < self.file.size else b""
            if not packed:
                raise ValueError(f"record at byte {self.begin} is cut off")
            self.at += len(packed)
        return self.unpack.decompress(packed, most)

    def header(self) -> bytes:
        while b"\r\n\r\n" not in self.data and not self.unpack.eof:
            self.data += self.more(2048)
        head, mark, self.data = self.data.partition(b"\r\n\r\n")
        if not mark or not head.startswith(b"WARC/"):
            raise ValueError(f"no WARC header at byte {self.begin}")
        return head

    def rest(self) -> bytes:
        parts = [self.data]
        while not self.unpack.eof:
            parts.append(self.more())
        return b"".join(parts)

    def end(self) -> int:
        if self.length:
            return self.begin + self.length
        while not self.unpack.eof:
            self.more(1 << 16)
        return self.at - len(self.unpack.unused_data) + 8


def _values(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            out[name.strip().lower()] = value.strip()
    return out


def _row(values: dict[str, str]) -> dict:
    row = {column: values.get(header.lower()) for column, header in HEADERS.items()}
    digest = row["payload_digest"] or ""
    if digest.startswith("sha1:") and len(digest) == 37:
        row["payload_digest"] = base64.b32decode(digest[5:]).hex()
    row["payload_bytes"] = int(row["payload_bytes"]) if (row["payload_bytes"] or "").isdigit() else None
    return row


def _payload(block: bytes, kind: str) -> bytes:
    return block.partition(b"\r\n\r\n")[2] if kind.startswith("application/http") else block


@dataclass
class Range(InputPartition):
    path: str
    begin: int
    end: int


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.payload = options.get("payload", "true").lower() != "false"
        self.range = int(options.get("range", RANGE))
        self.filters: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        """Takes equality, membership and prefixes of header columns; gives the others back."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column not in HEADERS:
                yield f
            elif isinstance(f, EqualTo):
                self.filters.append((column, "in", (f.value,)))
            elif isinstance(f, In):
                self.filters.append((column, "in", tuple(f.value)))
            elif isinstance(f, StringStartsWith):
                self.filters.append((column, "prefix", f.value))
            elif isinstance(f, IsNotNull):
                self.filters.append((column, "there", None))
            else:
                yield f

    def partitions(self):
        fs, root = pafs.FileSystem.from_uri(self.folder)
        infos = fs.get_file_info(pafs.FileSelector(root, recursive=True)) if fs.get_file_info(root).type == pafs.FileType.Directory else [fs.get_file_info(root)]
        marked = {info.path for info in infos if info.path.endswith(OFFSETS)}
        out = []
        for info in infos:
            if info.type != pafs.FileType.File or not info.base_name.endswith((".warc", ".warc.gz")) or "/_temporary/" in info.path:
                continue
            step = self.range if info.path + OFFSETS in marked else max(1, info.size)
            out += [Range(info.path, at, min(at + step, info.size)) for at in range(0, info.size, step)]
        return out or [Range("", 0, 0)]

    def _wanted(self, row: dict) -> bool:
        for column, kind, value in self.filters:
            have = row[column]
            if have is None or (kind == "in" and have not in value) or (kind == "prefix" and not have.startswith(value)):
                return False
        return True

    def _borders(self, fs: pafs.FileSystem, part: Range, size: int) -> tuple[int, int]:
        """The first record of a range and of what lies behind it."""
        if part.begin == 0 and part.end >= size:
            return 0, size
        with fs.open_input_stream(part.path + OFFSETS, compression=None) as stream:
            offsets = [*map(int, stream.read().split()), size]
        return offsets[bisect.bisect_left(offsets, part.begin)], offsets[bisect.bisect_left(offsets, part.end)]

    def _compressed(self, file: _File, begin: int, end: int) -> Iterator[dict]:
        at = begin
        while at < end:
            member = _Member(file, at)
            values = _values(member.header())
            row = _row(values)
            if self._wanted(row):
                row["payload"] = None
                if self.payload:
                    size = int(values.get("content-length", 0))
                    block = member.rest()
                    if len(block) < size:
                        raise ValueError(f"record at byte {at} is cut off")
                    row["payload"] = _payload(block[:size], values.get("content-type", ""))
                yield row
            at = member.end()

    def _plain(self, file: _File) -> Iterator[dict]:
        at = 0
        while at < file.size:
            head = b""
            while b"\r\n\r\n" not in head:
                more = file.read(at + len(head), 2048)
                if not more:
                    raise ValueError(f"no WARC header at byte {at}")
                head += more
            head = head.partition(b"\r\n\r\n")[0]
            values = _values(head)
            size, body = int(values.get("content-length", 0)), at + len(head) + 4
            row = _row(values)
            if self._wanted(row):
                row["payload"] = _payload(file.read(body, size), values.get("content-type", "")) if self.payload else None
                yield row
            at = body + size + 4

    def read(self, partition):
        if not partition.path:
            return
        fs, _ = pafs.FileSystem.from_uri(self.folder)
        file = _File(fs, partition.path)
        rows = self._compressed(file, *self._borders(fs, partition, file.size)) if partition.path.endswith(".gz") else self._plain(file)
        schema = pa.schema([(c, pa.int64() if c == "payload_bytes" else pa.string()) for c in HEADERS] + [("payload", pa.binary())])
        held, size = [], 0
        for row in rows:
            held.append(row)
            size += len(row["payload"] or b"") + 500
            if size > 4 << 20:
                yield pa.RecordBatch.from_pylist(held, schema)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)


@dataclass
class Written(WriterCommitMessage):
    path: str


def record(row: dict, level: int = 4) -> bytes:
    """One record as a gzip member that names its own length."""
    payload = row["payload"] or b""
    revisit = row["record_type"] == "revisit"
    head = ["WARC/1.1"]
    for column, header in HEADERS.items():
        value = row.get(column)
        if column == "payload_digest" and value:
            value = "sha1:" + base64.b32encode(bytes.fromhex(value)).decode()
        if value is not None:
            head.append(f"{header}: {quote(str(value), safe=''.join(map(chr, range(33, 127)))) if column == 'target_uri' else value}")
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (b"" if revisit else payload)
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    plain = "\r\n".join(head).encode() + block + b"\r\n\r\n"
    pack = zlib.compressobj(level, zlib.DEFLATED, -15)
    packed = pack.compress(plain) + pack.flush()
    total = 24 + len(packed) + 8
    known = total if total < 1 << 32 else 0
    extra = b"sl" + struct.pack("<HII", 8, known, len(plain) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + packed + struct.pack("<II", zlib.crc32(plain), len(plain) & 0xFFFFFFFF)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.folder, self.level, self.mark = options["path"], int(options.get("level", 4)), int(options.get("mark", MARK))
        self.job = uuid.uuid4().hex

    def write(self, iterator):
        fs, root = pafs.FileSystem.from_uri(self.folder)
        fs.create_dir(f"{root}/_temporary/{self.job}", recursive=True)
        path = f"{root}/_temporary/{self.job}/{uuid.uuid4().hex}.warc.gz"
        at, offsets = 0, [0]
        with fs.open_output_stream(path, compression=None) as out:
            for batch in iterator:
                for row in batch.to_pylist():
                    if at - offsets[-1] >= self.mark:
                        offsets.append(at)
                    packed = record(row, self.level)
                    out.write(packed)
                    at += len(packed)
        if not at:
            fs.delete_file(path)
            return Written("")
        with fs.open_output_stream(path + OFFSETS, compression=None) as out:
            out.write("\n".join(map(str, offsets)).encode())
        return Written(path)

    def commit(self, messages):
        fs, root = pafs.FileSystem.from_uri(self.folder)
        fs.create_dir(root, recursive=True)
        for m in messages:
            if m is not None and m.path:
                for path in (m.path + OFFSETS, m.path):  # an archive never stands without its offsets
                    fs.move(path, f"{root}/{path.rsplit('/', 1)[1]}")
        self.abort([])

    def abort(self, messages):
        fs, root = pafs.FileSystem.from_uri(self.folder)
        if fs.get_file_info(f"{root}/_temporary/{self.job}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{root}/_temporary/{self.job}")


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options)


def read_warc(spark: SparkSession, folder: str, payload: bool = True, **options) -> DataFrame:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").options(payload=str(payload).lower(), **options).load(folder)


def write_warc(df: DataFrame, folder: str, **options) -> None:
    df.sparkSession.dataSource.register(WarcSource)
    df.write.format("warc").options(**options).mode("append").save(folder)


def page_records(df: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """A record per page. Of equal payloads of at least ``SMALLEST_SHARED`` bytes the one with the largest id is the response;
    the others revisit it and carry no payload."""
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    bare = df.select(F.col(id).alias("id"), F.col(url).alias("url"), payload.alias("payload"))
    bare = bare.select("*", F.sha2("payload", 256).alias("sha"), F.octet_length("payload").cast("long").alias("n"))
    groups = bare.filter(F.col("n") >= SMALLEST_SHARED).groupBy("sha").agg(F.count("*").alias("c"), F.max("id").alias("keep"))
    groups = stored(groups.filter("c > 1 AND keep IS NOT NULL").select("sha", "keep"))
    found = bare.join(groups, "sha", "left")
    revisit = F.col("keep").isNotNull() & ~F.col("keep").eqNullSafe(F.col("id"))

    def name(column: str):
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("none")), F.lit(">"))

    return found.select(
        name("id").alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.lit(DATE).alias("date"),
        F.sha1("payload").alias("payload_digest"),
        F.col("n").alias("payload_bytes"),
        F.when(revisit, name("keep")).alias("refers_to"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def op5_warc(spark, folder):
    """Responses are told by what their payload unpacks to, revisits by their headers alone."""
    target = f"{intermediate_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(page_records(pages(spark, folder)), target)
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    full = read_warc(spark, target).filter("record_type = 'response'")
    short = read_warc(spark, target, payload=False).filter("record_type = 'revisit'")
    parts = (
        full.select("record_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"), "record_type", "refers_to"),
        short.select("record_id", "payload_bytes", "payload_digest", "record_type", "refers_to"),
    )
    return parts[0].unionByName(parts[1]).select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to")
    )


QUERIES = {"op5_warc": op5_warc}
ORACLE = {
    "op5_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        g AS (SELECT page_id, h, octet_length(encode(h)) AS n, max(page_id) OVER (PARTITION BY h) AS keep FROM p)
        SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest,
               CASE WHEN n >= 1000 AND page_id <> keep THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND page_id <> keep THEN keep END AS refers_to FROM g
    """
}
