"""The first lines and the byte-order mark of every file, from its first bytes alone.

Spark lists the files; each task opens the ones it is given through pyarrow's file systems, reads ranges of 64 KB
from the start until it has the lines it wants, and leaves the rest unread, however long the file.
Compressed files (gz, bz2, zst, xz, deflate) are inflated as far. File systems that pyarrow lacks are read by Spark's
own text reader instead, which goes through the whole file.
"""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractframe.sources.quotes import Machine
from contractframe.storage import ship_package

RANGE = 1 << 16

# Byte-order marks and the encodings they tell.
MARKS = {b"\xef\xbb\xbf": "utf-8-sig", b"\xff\xfe": "utf-16-le", b"\xfe\xff": "utf-16-be"}

# Schemes of the file systems that pyarrow opens.
SYSTEMS = ("", "file", "s3", "s3a", "gs", "gcs", "hdfs", "abfs", "abfss")


def files_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, size) of every file that is not empty. Only listed, never opened."""
    listed = spark.read.format("binaryFile").load(list(paths))
    return listed.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).where("size > 0")


def opened(file: str):
    """A binary stream of the file's content, inflated if its name tells so."""
    import bz2
    import lzma
    import zlib
    from urllib.parse import unquote, urlsplit

    import pyarrow as pa
    from pyarrow import fs

    if file.lower().endswith((".lz4", ".snappy")):
        raise ValueError(f"{file}: lz4 and snappy files are not read")
    parts = urlsplit(file)
    if parts.scheme in ("", "file"):
        system, path = fs.LocalFileSystem(), unquote(parts.path)
    else:
        system, path = fs.FileSystem.from_uri(unquote(file.replace("s3a://", "s3://", 1)))
    raw = system.open_input_stream(path, compression=None)
    name = file.lower()
    if name.endswith((".gz", ".zst")):
        return pa.CompressedInputStream(raw, "gzip" if name.endswith(".gz") else "zstd")
    if name.endswith(".bz2"):
        return bz2.BZ2File(io.BufferedReader(raw, RANGE)) if not isinstance(raw, io.RawIOBase) else bz2.BZ2File(raw)
    if name.endswith(".xz"):
        return lzma.LZMAFile(raw)
    if name.endswith(".deflate"):
        return _Inflated(raw, zlib.decompressobj())
    return raw


class _Inflated:
    """A stream without its own framing, inflated range by range."""

    def __init__(self, raw, codec):
        self.raw, self.codec = raw, codec

    def read(self, n: int) -> bytes:
        out = b""
        while not out:
            packed = self.raw.read(n)
            if not packed:
                return self.codec.flush()
            out = self.codec.decompress(packed)
        return out


def first_lines(read: Callable[[int], bytes]) -> Iterator[tuple[str | None, bytes]]:
    """(mark, line) for line after line, reading ranges only as they are asked for.

    Lines of a 16-bit file come as UTF-8. The last line needs no line end; an empty file has no line.
    """
    held = read(RANGE)
    while 0 < len(held) < 3:
        more = read(RANGE)
        if not more:
            break
        held += more
    mark = next((m for m in MARKS if held.startswith(m)), b"")
    name, wide = MARKS.get(mark), len(mark) == 2
    held = held[len(mark) :]
    end = "\n".encode(name) if wide else b"\n"
    at = 0
    while True:
        stop = held.find(end, at)
        while wide and stop >= 0 and stop % 2:
            stop = held.find(end, stop + 1)
        if stop < 0:
            more = read(RANGE)
            if more:
                if wide and at % 2 == 0 or not wide:
                    held, at = held[at:], 0
                held += more
                continue
            if at < len(held):
                yield name, _narrow(held[at:], name, wide)
            return
        yield name, _narrow(held[at:stop], name, wide)
        at = stop + len(end)


def _narrow(line: bytes, name: str | None, wide: bool) -> bytes:
    return line.decode(name, "replace").encode() if wide else line


def _text(line: bytes, fallback: str) -> str:
    try:
        out = line.decode()
    except UnicodeDecodeError:
        out = line.decode(fallback)
    return out.removesuffix("\r")


def is_blank(line: bytes, sep: str) -> bool:
    """No character but spaces and tabs that separate nothing."""
    return not line.strip(b" \r\x0b\x0c" if sep == "\t" else b" \r\t\x0b\x0c")


def head_of(read: Callable[[int], bytes], sep: str, lines: int | None, records: int | None, fallback: str):
    """The first ``lines`` lines, or as many as the first ``records`` records that are not blank need.

    Gives (mark, ordinal, line, begins, blank, cells): whether a record begins with the line, and the cells of
    the record, which may go on over further lines, or else of the line.
    """
    csv.field_size_limit(sys.maxsize)
    machine, out, parts, begun = Machine(sep), [], [], 0
    for mark, line in first_lines(read):
        begins, blank = not machine.open, not machine.open and is_blank(line, sep)
        if begins and (len(out) == lines or begun == records):
            break
        if lines is None or len(out) < lines:
            out.append([mark, len(out), _text(line, fallback), begins, blank, None])
            parts.append([])
        begun += begins and not blank
        machine.feed(line)
        parts[-1 if not begins else len(out) - 1].append(_text(line, fallback))
        if len(out) == lines and not machine.open:
            break
    # A record's cells: of all lines up to the next beginning.
    for i, row in enumerate(out):
        if row[3]:
            record = list(parts[i])
            for j in range(i + 1, len(out)):
                if out[j][3]:
                    break
                record += parts[j]
        else:
            record = [row[2]]
        row[5] = next(csv.reader(io.StringIO("\n".join(record), newline=""), delimiter=sep), [])
    return out


_HEAD = "file string, mark string, ordinal int, line string, begins boolean, blank boolean, cells array<string>"


def can_open(paths: list[str]) -> bool:
    from urllib.parse import urlsplit

    return all(urlsplit(p).scheme in SYSTEMS for p in paths)


def heads(spark: SparkSession, paths: list[str], sep: str | None, lines: int | None, records: int | None, fallback: str) -> DataFrame:
    """``head_of`` for every file; ``sep`` None goes by the file's ending."""
    ship_package(spark)

    def read_heads(data):
        import pyarrow as pa

        names = [c.split()[0] for c in _HEAD.split(", ")]
        for batch in data:
            for file in batch.column("file").to_pylist():
                with_sep = sep or ("\t" if file.lower().endswith((".tsv", ".tab")) else ",")
                rows = [(file, *row) for row in head_of(opened(file).read, with_sep, lines, records, fallback)]
                types = [pa.string(), pa.string(), pa.int32(), pa.string(), pa.bool_(), pa.bool_(), pa.list_(pa.string())]
                columns = list(zip(*rows)) or [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return files_of(spark, paths).select("file").mapInArrow(read_heads, _HEAD)


def capped_lines(spark: SparkSession, paths: list[str], sep: str, records: int) -> DataFrame:
    """(file, block, pos, value): the lines of the first ``records`` records of every file, and no byte much beyond.

    A file is read by one task, from its start, as far as the cap reaches.
    """
    ship_package(spark)

    def read_lines(data):
        import pyarrow as pa

        for batch in data:
            for file in batch.column("file").to_pylist():
                machine, begun, rows, start = Machine(sep), 0, [], 0

                def out(rows, start):
                    n = len(rows)
                    return pa.RecordBatch.from_arrays(
                        [pa.array([file] * n), pa.array([0] * n, pa.int64()), pa.array(range(start, start + n), pa.int64()), pa.array(rows, pa.binary())],
                        names=["file", "block", "pos", "value"],
                    )

                for _, line in first_lines(opened(file).read):
                    if not machine.open:
                        if begun == records:
                            break
                        begun += not is_blank(line, sep)
                    machine.feed(line)
                    rows.append(line)
                    if len(rows) == 5000:
                        yield out(rows, start)
                        rows, start = [], start + 5000
                yield out(rows, start)

    lines = files_of(spark, paths).select("file").mapInArrow(read_lines, "file string, block bigint, pos bigint, value binary")
    return lines.withColumn("value", F.col("value").cast("string"))
