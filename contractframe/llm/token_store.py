"""Token ids in binary files: one zstandard frame per document, with a dictionary shared by all.

A folder holds ``dictionary-<sha256>.zdict``, trained on the id arrays of a bounded sample, and one
``part-*.tokz`` per task. A part file is its frames, then an index, then a fixed tail:

    frames     zstandard frames, without the dictionary; each holds the ids of one document
    index      little-endian arrays: doc ids int64, "id is given" uint8, frame ends uint64, id counts uint32
    tail       rows uint64, bytes per id uint8, dictionary sha256 (32 bytes), magic ``TOKZ0001``

so one document is read by the tail, the index and its own frame alone. Files are written in ascending
document order (the order of the parts is in the returned manifest, a row per file). Tasks that run again
write new names; files that no manifest names are ignored.

Defined results: null and empty texts hold just the end id; null ids come first; rows of one id follow
the hash of their texts; equal rows are all written; an empty table gives an empty manifest; other input
columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractframe.llm.common import batches, ground, row_key, ship_package, slices
from contractframe.llm.token_ids import encode_texts

MAGIC = b"TOKZ0001"
_TAIL = "<QB32s8s"
#: Bounds of the dictionary: its bytes, and the documents and characters of each that it is trained on.
DICTIONARY_BYTES, SAMPLE_ROWS, SAMPLE_CHARS = 64 << 10, 1000, 4000


def filesystem(path: str):
    """The file system of a path that executors share, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def train_dictionary(narrow: DataFrame, vocabulary: str, end_id: int = 0, width: int = 2) -> bytes:
    """A dictionary from the SAMPLE_ROWS documents of smallest hash, at most SAMPLE_CHARS of each.

    Empty where there is too little to learn from; frames then stand alone.
    """
    import zstandard

    hashed = narrow.withColumn("h", F.xxhash64("doc_id", "_k", F.lit(8)))
    # First the smallest hashes alone, then their texts: tasks would each send SAMPLE_ROWS texts otherwise.
    picked = narrow.sparkSession.createDataFrame(hashed.select("h").orderBy("h").limit(SAMPLE_ROWS).distinct().collect(), "_h bigint")
    rows = hashed.join(F.broadcast(picked), F.col("h") == F.col("_h")).select("h", F.substring("text", 1, SAMPLE_CHARS).alias("text"))
    rows = rows.dropDuplicates(["h"]).orderBy("h")
    samples = [_serialized(ids, width) for ids in encode_texts(vocabulary, [r["text"] for r in rows.collect()], end_id)]
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, samples)) // 8), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _serialized(ids: bytes, width: int) -> bytes:
    import numpy as np

    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def write_tokens(docs: DataFrame, folder: str, vocabulary: str, *, id_column: str = "doc_id", text_column: str = "text", end_id: int = 0) -> DataFrame:
    """Write all documents and return the manifest: part, path, n_docs, n_tokens; a row per file.

    Runs the writing job; the manifest is small and held by the returned frame.
    """
    import pyarrow as pa
    import zstandard
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    ship_package(spark)
    width = 2 if max(Tokenizer.from_str(vocabulary).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    narrow = ground(docs, doc_id=F.col(id_column).cast("bigint"), text=F.col(text_column), _k=row_key(F.col(text_column)))
    dictionary = train_dictionary(narrow, vocabulary, end_id, width)
    digest = hashlib.sha256(dictionary).digest()
    store, at = filesystem(folder)
    store.create_dir(at, recursive=True)
    with store.open_output_stream(f"{at}/dictionary-{digest.hex()}.zdict") as out:
        out.write(dictionary)

    def write(stream):
        from pyspark import TaskContext

        import numpy as np

        compressor = _compressor(dictionary)
        files, base = filesystem(folder)
        out, written, known, ends, counts = None, [], [], [], []
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.tokz"
        end = 0
        for batch in stream:
            for part in slices(batch, "text"):
                out = out or files.open_output_stream(f"{base}/{name}")
                for doc, ids in zip(part.column("doc_id").to_pylist(), encode_texts(vocabulary, part.column("text").to_pylist(), end_id)):
                    frame = compressor.compress(_serialized(ids, width))
                    out.write(frame)
                    end += len(frame)
                    written.append(doc or 0)
                    known.append(doc is not None)
                    ends.append(end)
                    counts.append(len(ids) // 4)
        if out:
            for values, kind in ((written, "<i8"), (known, "u1"), (ends, "<u8"), (counts, "<u4")):
                out.write(np.array(values, kind).tobytes())
            out.write(struct.pack(_TAIL, len(written), width, digest, MAGIC))
            out.close()
            row = {"part": TaskContext.get().partitionId(), "path": f"{folder}/{name}", "n_docs": len(written), "n_tokens": sum(counts)}
            yield batches({k: ([v], pa.string() if k == "path" else pa.int64()) for k, v in row.items()})

    # The hash of the text lets the ranges split an id of very many rows.
    ordered = narrow.repartitionByRange("doc_id", "_k").sortWithinPartitions("doc_id", "_k").select("doc_id", "text")
    schema = "part bigint, path string, n_docs bigint, n_tokens bigint"
    return spark.createDataFrame(sorted(tuple(r) for r in ordered.mapInArrow(write, schema).collect()), schema)


def _compressor(dictionary: bytes):
    import zstandard

    return zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None, write_dict_id=False)


class TokenFile:
    """One part file, opened by its tail and index; frames are read on demand."""

    def __init__(self, path: str):
        import numpy as np
        import zstandard

        files, at = filesystem(path)
        self.file = files.open_input_file(at)
        size = self.file.size()
        rows, self.width, digest, magic = struct.unpack(_TAIL, self.file.read_at(struct.calcsize(_TAIL), size - struct.calcsize(_TAIL)))
        if magic != MAGIC:
            raise ValueError(f"{path} is no token file")
        with files.open_input_stream(f"{at.rpartition('/')[0]}/dictionary-{digest.hex()}.zdict") as given:
            dictionary = given.read()
        if hashlib.sha256(dictionary).digest() != digest:
            raise ValueError(f"the dictionary of {path} is not the one it was written with")
        start = size - struct.calcsize(_TAIL) - 21 * rows
        index = self.file.read_at(21 * rows, start)
        self.doc_ids = np.frombuffer(index, "<i8", rows)
        self.known = np.frombuffer(index, "u1", rows, 8 * rows).astype(bool)
        self.ends = np.frombuffer(index, "<u8", rows, 9 * rows).astype("int64")
        self.counts = np.frombuffer(index, "<u4", rows, 17 * rows).astype("int64")
        self.begins = np.concatenate([[0], self.ends[:-1]]).astype("int64")
        self.decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)

    def _ids(self, frame: bytes, count: int):
        import numpy as np

        raw = self.decompressor.decompress(frame, max_output_size=max(1, count * self.width))
        return np.frombuffer(raw, "<u2" if self.width == 2 else "<u4").astype("<u4")

    def ids(self, row: int):
        """The ids of one document."""
        begin, end = int(self.begins[row]), int(self.ends[row])
        return self._ids(self.file.read_at(end - begin, begin), int(self.counts[row]))

    def document(self, doc_id: int):
        """The ids of the first document of this id, found in the ascending index."""
        import numpy as np

        given = int((~self.known).sum())
        at = given + int(np.searchsorted(self.doc_ids[given:], doc_id))
        if at >= len(self.doc_ids) or self.doc_ids[at] != doc_id:
            raise KeyError(doc_id)
        return self.ids(at)

    def blocks(self, most_bytes: int = 4 << 20) -> Iterator[tuple[int, list]]:
        """All documents in order: (first row, ids of each), read in blocks of about ``most_bytes``."""
        row = 0
        while row < len(self.ends):
            begin, last = int(self.begins[row]), row + 1
            while last < len(self.ends) and self.ends[last] - begin <= most_bytes:
                last += 1
            raw = self.file.read_at(int(self.ends[last - 1]) - begin, begin)
            yield row, [self._ids(raw[int(self.begins[i]) - begin : int(self.ends[i]) - begin], int(self.counts[i])) for i in range(row, last)]
            row = last


def read_tokens(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    import pyarrow as pa

    ship_package(spark)
    rows, start = [], 0
    for r in sorted(manifest.collect()):  # a row per file
        rows.append((r["path"], start))
        start += r["n_tokens"]
    given = spark.createDataFrame(rows, "path string, first bigint")

    def read(stream):
        for batch in stream:
            for path, first in zip(batch.column("path").to_pylist(), batch.column("first").to_pylist()):
                file = TokenFile(path)
                for row, documents in file.blocks():
                    n, at = [len(ids) for ids in documents], row + len(documents)
                    starts = []
                    for count in n:
                        starts.append(first)
                        first += count
                    yield batches({
                        "doc_id": (pa.array(file.doc_ids[row:at], mask=~file.known[row:at]), pa.int64()),
                        "start": (starts, pa.int64()),
                        "n_tokens": (n, pa.int64()),
                        "ids_crc32": ([zlib.crc32(ids.tobytes()) for ids in documents], pa.int64()),
                    })

    spread = given.repartition(max(1, len(rows)), "path")
    return spread.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
