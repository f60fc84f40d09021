"""WARC archives as a Spark data source, and pages archived with revisit records.

``spark.read.format("warc")`` plans one input partition per group of files, reads the header of each
record first and applies the pushed-down predicates on header columns to it; what they reject is skipped
without decoding its payload, and no payload is decoded at all when the schema has no ``payload`` column.
``df.write.format("warc")`` writes one gzip member per record. Members carry their lengths in the
``sl`` extra field, so a reader can step over them; members without it are inflated to find their end.
Files count once their job has committed: a manifest names them, and a folder without any manifest (an
archive from elsewhere) is read whole.

Defined results of ``archive_pages``: a null payload is empty; a null url gives no target header; control
characters in urls are percent-encoded; among equal payloads null ids count as smallest, and rows that
share the largest id are all responses; a null id is read back as null; empty tables give empty archives;
other input columns are ignored.
"""

from __future__ import annotations

import base64
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

from contractframe.llm.common import ground, materialize, ship_package
from contractframe.llm.token_store import filesystem

#: Columns known from the header alone.
HEADER_COLUMNS = {
    "record_type": "string", "record_id": "string", "target_uri": "string", "date": "string", "refers_to": "string",
    "payload_digest": "string", "payload_length": "bigint", "headers": "map<string,string>",
}
SCHEMA = ", ".join(f"{k} {v}" for k, v in HEADER_COLUMNS.items()) + ", payload binary"
#: What a frame to be written must have; ``payload`` of revisits is not read.
WRITE_COLUMNS = ("record_type", "record_id", "target_uri", "date", "refers_to", "payload_digest", "payload_length", "payload")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PARTITION_BYTES, _BLOCK, _ROWS_BYTES = 64 << 20, 4 << 20, 8 << 20


# Records as bytes

def record_bytes(kind: str, record_id: str, payload: bytes, *, digest_hex: str, length: int, target_uri: str | None = None, date: str | None = None, refers_to: str | None = None) -> bytes:
    """One record: the block is an HTTP response head, and for responses the payload."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    if kind == "response":
        block += payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date or '1970-01-01T00:00:00Z'}"]
    if target_uri is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", target_uri))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += [
        "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest_hex)).decode(),
        "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(record: bytes) -> bytes:
    """A gzip member whose extra field ``sl`` holds its compressed and its plain length."""
    deflate = zlib.compressobj(4, zlib.DEFLATED, -15)
    body = deflate.compress(record) + deflate.flush()
    total = 10 + 2 + 12 + len(body) + 8
    head = b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff" + struct.pack("<H2sHII", 12, b"sl", 8, total, len(record))
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


class _Blocks:
    """Bytes of a file at any place, read in blocks."""

    def __init__(self, file):
        self.file, self.size, self.at, self.block = file, file.size(), 0, b""

    def get(self, at: int, n: int) -> bytes:
        n = min(n, self.size - at)
        if not self.at <= at <= at + n <= self.at + len(self.block):
            self.at, self.block = at, self.file.read_at(min(max(n, _BLOCK), self.size - at), at)
        return self.block[at - self.at : at - self.at + n]


def _parse_header(head: bytes) -> dict[str, str]:
    found = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        if name:
            found[name.strip().lower()] = value.strip()
    return found


def _has_heads(raw: bytes) -> bool:
    """Whether the record's header is all there, and the HTTP head that may follow it."""
    head, blank, block = raw.partition(b"\r\n\r\n")
    return bool(blank) and (b"\r\n\r\n" in block or not _parse_header(head).get("content-type", "").startswith("application/http"))


class _Gzip:
    """A record in a gzip member: its header now, its whole bytes when asked for."""

    def __init__(self, blocks: _Blocks, at: int):
        self.blocks, self.at = blocks, at
        start = blocks.get(at, 24)
        known = start[3] & 4 and start[12:14] == b"sl" and struct.unpack("<H", start[14:16])[0] == 8
        self.length = struct.unpack("<I", start[16:20])[0] if known else None
        inflate, plain, step = zlib.decompressobj(31), b"", 2048
        while not inflate.eof and at < blocks.size and not _has_heads(plain):
            raw = blocks.get(at, step)
            plain += inflate.decompress(raw)
            at, step = at + len(raw), step * 2
        self.start = plain
        self.header = plain.partition(b"\r\n\r\n")[0]

    def whole(self) -> bytes:
        inflate, plain, at = zlib.decompressobj(31), [], self.at
        while not inflate.eof and at < self.blocks.size:
            raw = self.blocks.get(at, self.length - (at - self.at) if self.length else 1 << 16)
            plain.append(inflate.decompress(raw))
            at += len(raw)
        if not inflate.eof:
            raise ValueError("a record breaks off")
        self.length = at - self.at - len(inflate.unused_data)
        return b"".join(plain)

    def end(self) -> int:
        if self.length is None:
            self.whole()
        return self.at + self.length


class _Plain:
    """A record of an archive that is not compressed."""

    def __init__(self, blocks: _Blocks, at: int):
        self.blocks, self.at, n = blocks, at, 4096
        while not _has_heads(raw := blocks.get(at, n)) and at + n < blocks.size:
            n *= 2
        self.start, self.header = raw, raw.partition(b"\r\n\r\n")[0]
        self.length = len(self.header) + 4 + int(_parse_header(self.header).get("content-length", 0)) + 4

    def whole(self) -> bytes:
        return self.blocks.get(self.at, self.length)

    def end(self) -> int:
        return self.at + self.length


def records(file) -> Iterator[_Gzip | _Plain]:
    blocks, at = _Blocks(file), 0
    while at < blocks.size:
        record = _Gzip(blocks, at) if blocks.get(at, 2) == b"\x1f\x8b" else _Plain(blocks, at)
        yield record
        at = record.end()


def _header_row(record) -> dict:
    h = _parse_header(record.header)
    bare = lambda k: h[k].strip("<>") if k in h else None
    digest = h.get("warc-payload-digest", "")
    if digest.startswith("sha1:") and len(digest) == 37:
        digest = base64.b32decode(digest[5:]).hex()
    http = record.start[len(record.header) + 4 :].partition(b"\r\n\r\n")[0]
    length = re.search(rb"(?im)^content-length:[ \t]*(\d+)", http) if h.get("content-type", "").startswith("application/http") else None
    return {
        "record_type": h.get("warc-type"), "record_id": bare("warc-record-id"), "target_uri": h.get("warc-target-uri"),
        "date": h.get("warc-date"), "refers_to": bare("warc-refers-to"), "payload_digest": digest or None,
        "payload_length": int(length[1]) if length else None, "headers": list(h.items()),
    }


def _payload(record, row: dict) -> bytes:
    whole = record.whole()
    start = len(record.header) + 4
    block = whole[start : start + int(dict(row["headers"]).get("content-length", 0))]
    if dict(row["headers"]).get("content-type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


# The data source

@dataclass
class _Files(InputPartition):
    paths: list[str]


class WarcSource(DataSource):
    """Format ``warc``: option ``path`` is a folder that all executors reach."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options["path"], schema)

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("archives are only added to; write to a new folder or append")
        return WarcWriter(self.options["path"])


class WarcReader(DataSourceReader):
    def __init__(self, path, schema):
        self.path, self.fields, self.wanted = path.rstrip("/"), [f.name for f in schema.fields], []
        self.schema = schema

    def pushFilters(self, filters):
        """Takes equality, IN, prefix and not-null on header columns; Spark applies the others."""
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if isinstance(f, (EqualTo, In, StringStartsWith, IsNotNull)) and name in HEADER_COLUMNS and name != "headers":
                value = getattr(f, "value", None)
                self.wanted.append((type(f).__name__, name, set(value) if isinstance(f, In) else value))
            else:
                yield f

    def partitions(self):
        from pyarrow import fs

        store, at = filesystem(self.path)
        there = [f for f in store.get_file_info(fs.FileSelector(at)) if f.is_file]
        sizes = {f.base_name: f.size for f in there if re.search(r"\.warc(\.gz)?$", f.base_name)}
        manifests = [f.path for f in there if f.base_name.startswith("_files-")]
        if manifests:
            sizes = {n: sizes[n] for m in manifests for n in json.loads(store.open_input_stream(m).read())}
        groups, room = [], 0
        for name in sorted(sizes):
            if room < sizes[name]:
                groups.append([])
                room = _PARTITION_BYTES
            groups[-1].append(f"{self.path}/{name}")
            room -= sizes[name]
        return [_Files(g) for g in groups] or [_Files([])]

    def _keeps(self, row: dict) -> bool:
        for kind, name, value in self.wanted:
            own = row[name]
            if own is None or kind == "EqualTo" and own != value or kind == "In" and own not in value or kind == "StringStartsWith" and not own.startswith(value):
                return False
        return True

    def read(self, partition):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds, rows, size = to_arrow_schema(self.schema), [], 0
        make = lambda: pa.RecordBatch.from_arrays([pa.array([r.get(f) for r in rows], kinds.field(f).type) for f in self.fields], schema=kinds)
        for path in partition.paths:
            store, at = filesystem(path)
            with store.open_input_file(at) as file:
                for record in records(file):
                    row = _header_row(record)
                    if not self._keeps(row):
                        continue
                    if "payload" in self.fields:
                        row["payload"] = _payload(record, row)
                    rows.append(row)
                    size += 1000 + len(row.get("payload", b""))
                    if size >= _ROWS_BYTES:
                        yield make()
                        rows, size = [], 0
        if rows:
            yield make()


@dataclass
class _Written(WriterCommitMessage):
    name: str | None


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path):
        self.path = path.rstrip("/")

    def write(self, iterator):
        store, at = filesystem(self.path)
        store.create_dir(at, recursive=True)
        name, out = f"part-{uuid.uuid4().hex}.warc.gz", None
        for batch in iterator:
            columns = [batch.column(c) for c in WRITE_COLUMNS]
            for i in range(batch.num_rows):
                kind, record_id, uri, date, refers_to, digest, length, payload = (c[i].as_py() for c in columns)
                out = out or store.open_output_stream(f"{at}/{name}", compression=None)
                out.write(gzip_member(record_bytes(
                    kind, record_id, payload or b"", digest_hex=digest, length=length, target_uri=uri, date=date, refers_to=refers_to
                )))
        if out:
            out.close()
        return _Written(name if out else None)

    def commit(self, messages):
        store, at = filesystem(self.path)
        store.create_dir(at, recursive=True)
        with store.open_output_stream(f"{at}/_files-{uuid.uuid4().hex}") as out:
            out.write(json.dumps([m.name for m in messages if m and m.name]).encode())

    def abort(self, messages):
        store, at = filesystem(self.path)
        for m in messages:
            if m and m.name:
                store.delete_file(f"{at}/{m.name}")


def use_warc(spark: SparkSession) -> None:
    """Register the format in this session, with predicates pushed to it."""
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def read_warc(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    use_warc(spark)
    schema = SCHEMA if payload else SCHEMA.replace(", payload binary", "")
    return spark.read.format("warc").schema(schema).load(folder)


# Pages

def page_records(pages: DataFrame, least_bytes: int = 1000, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html") -> DataFrame:
    """One record to write per page: repeated payloads of at least ``least_bytes`` become revisits.

    Groups of equal payloads are first summed up by digest (a partial maximum per task), and only groups of
    two or more meet the pages again, in a join of two plain shuffles that adaptive execution can split.
    """
    own = ground(
        pages, page_id=F.col(id_column).cast("bigint"), target_uri=F.col(url_column),
        payload=F.coalesce(F.col(payload_column).cast("binary"), F.lit(b"")),
    ).select("*", F.sha1("payload").alias("payload_digest"), F.octet_length("payload").cast("bigint").alias("payload_length"))
    groups = own.where(F.col("payload_length") >= least_bytes).groupBy("payload_digest").agg(F.max("page_id").alias("_first"), F.count("*").alias("_n"))
    repeated = materialize(groups.where("_n > 1").select(F.col("payload_digest").alias("_digest"), "_first"), "repeated-payloads")
    told = own.join(repeated, (F.col("payload_digest") == F.col("_digest")) & (F.col("payload_length") >= least_bytes), "left")
    revisit = F.col("_digest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("none")))
    return told.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), name(F.col("page_id")).alias("record_id"), "target_uri",
        F.lit(None).cast("string").alias("date"), F.when(revisit, name(F.col("_first"))).alias("refers_to"), "payload_digest", "payload_length",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write_warc(rows: DataFrame, folder: str) -> None:
    use_warc(rows.sparkSession)
    rows.select(*WRITE_COLUMNS).write.format("warc").mode("append").save(folder)


def archive_pages(pages: DataFrame, folder: str, least_bytes: int = 1000) -> DataFrame:
    """Write all pages to ``folder`` and read the archives back.

    The digest and length of a response are taken from its payload as read, those of a revisit from its header.
    """
    write_warc(page_records(pages, least_bytes), folder)
    got = read_warc(pages.sparkSession, folder)
    full = F.col("record_type") == "response"
    page = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^urn:page:(-?[0-9]+)$', 1) AS bigint)")
    return got.select(
        page("record_id").alias("page_id"),
        F.when(full, F.octet_length("payload").cast("bigint")).otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(full, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", page("refers_to").alias("refers_to"),
    )
