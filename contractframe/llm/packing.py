"""Packing documents into fixed-length sequences: shortest-pack-first over the length histogram.

Each document becomes token ids and an end id, cut into whole sequences and a rest. The histogram of
piece lengths (at most ``max_length`` rows) is packed on the driver: lengths are placed longest first,
each into the packs that have most room left, and what changes are counts of packing patterns, never
single documents. Patterns then say which ranks of a length go to which sequence and offset, and
pieces find their place by their rank among the pieces of equal length.

Defined results: null and empty texts are one piece holding the end id; a very long text is many whole
sequences and a rest; equal rows are packed one by one; a null id stays null; an empty table gives no
rows; other input columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contractframe.llm.common import batches, ground, materialize, ship_package, slices
from contractframe.llm.token_ids import encode_texts

_PIECE_SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
_RANK_CHUNK = 20_000  # pieces of one length ranked by one task group; the results do not depend on it


def pieces(docs: DataFrame, vocabulary: str, max_length: int = 1024, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per piece of a document: whole sequences from its start, then the rest."""
    import pyarrow as pa

    ship_package(docs.sparkSession)

    def cut(stream):
        step = 4 * max_length
        for batch in stream:
            for part in slices(batch, "text"):
                sizes, sums = [], []
                for ids in encode_texts(vocabulary, part.column("text").to_pylist()):
                    sizes.append(len(ids))
                    if len(ids) <= step:
                        sums.append(zlib.crc32(ids))
                    else:
                        sums += [zlib.crc32(ids[at : at + step]) for at in range(0, len(ids), step)]
                tokens = np.array(sizes, "int64") // 4
                pieces = -(-tokens // max_length)
                doc = np.repeat(np.arange(len(tokens)), pieces)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * max_length
                yield batches({
                    "doc_id": (part.column("doc_id").take(pa.array(doc)), None),
                    "start": (start, pa.int64()),
                    "length": (np.minimum(max_length, tokens[doc] - start), pa.int64()),
                    "ids_crc32": (sums, pa.int64()),
                    "doc_tokens": (tokens[doc], pa.int64()),
                })

    narrow = ground(docs, doc_id=F.col(id_column).cast("bigint"), text=F.col(text_column))
    return narrow.mapInArrow(cut, _PIECE_SCHEMA)


def shortest_pack_first(histogram: dict[int, int], max_length: int) -> list[tuple[int, tuple[int, ...]]]:
    """Packing patterns and how often each is used, for ``histogram`` of lengths 1 to ``max_length``.

    Every length changes each pattern it meets as a whole, except the last one it splits, so there are
    at most as many patterns as lengths.
    """
    room: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)  # free tokens -> (count, pattern)
    for length in sorted(histogram, reverse=True):
        left, free = histogram[length], max_length
        changed = []
        while left and free >= length:  # the shortest packs, those with most room, come first
            if not room[free]:
                free -= 1
                continue
            count, pattern = room[free].pop()
            used = min(count, left)
            if count > used:
                room[free].append((count - used, pattern))
            changed.append((free - length, used, (*pattern, length)))
            left -= used
            if used and free - length >= length and left:
                # a pack may take this length again; offer it at its new room before older, fuller packs
                to, n, p = changed.pop()
                room[to].append((n, p))
        if left:
            each = max_length // length
            full, rest = divmod(left, each)
            if full:
                changed.append((max_length - each * length, full, (length,) * each))
            if rest:
                changed.append((max_length - rest * length, 1, (length,) * rest))
        for to, n, p in changed:
            room[to].append((n, p))
    return [entry for free in sorted(room) for entry in room[free]]


def _places(patterns: list[tuple[int, tuple[int, ...]]]) -> dict[int, list[tuple[int, int, int]]]:
    """Per length: (first rank, first sequence, offset) of each run of ranks, ascending by rank."""
    taken: dict[int, int] = defaultdict(int)
    places: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    sequence = 0
    for count, pattern in patterns:
        offset = 0
        for length in pattern:
            places[length].append((taken[length], sequence, offset))
            taken[length] += count
            offset += length
        sequence += count
    return places


def pack(stored: DataFrame, max_length: int = 1024) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces (read twice)."""
    import numpy as np
    import pyarrow as pa

    histogram = {r["length"]: r["count"] for r in stored.groupBy("length").count().collect()}  # max_length rows
    places = {k: np.array(v, "int64").T for k, v in _places(shortest_pack_first(histogram, max_length)).items()}
    chunks = 1 + sum(histogram.values()) // _RANK_CHUNK

    def place(stream):
        for batch in stream:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "_rank"))
            sequence, offset = np.zeros(len(length), "int64"), np.zeros(len(length), "int64")
            for value in np.unique(length):
                at = np.flatnonzero(length == value)
                first, base, own_offset = places[int(value)]
                run = np.searchsorted(first, rank[at], side="right") - 1
                sequence[at] = base[run] + rank[at] - first[run]
                offset[at] = own_offset[run]
            kept = batch.drop_columns(["_rank"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(sequence), pa.array(offset)], names=[*kept.schema.names, "sequence_id", "offset"]
            )

    ranked = _rank(stored, chunks)
    return ranked.mapInArrow(place, f"{_PIECE_SCHEMA}, sequence_id bigint, offset bigint")


def _rank(stored: DataFrame, chunks: int) -> DataFrame:
    """0-based rank among pieces of equal length; a frequent length is ranked in chunks dealt by hash."""
    from pyspark.sql import Window

    dealt = stored.withColumn("_chunk", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(chunks)))
    before = Window.partitionBy("length").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = dealt.groupBy("length", "_chunk").agg(F.count("*").alias("_n")).select(
        F.col("length").alias("_l"), F.col("_chunk").alias("_c"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")
    )
    inside = Window.partitionBy("length", "_chunk").orderBy("doc_id", "start", "ids_crc32")
    numbered = dealt.withColumn("_in", F.row_number().over(inside).cast("bigint") - 1)
    joined = numbered.join(base, (F.col("length") == F.col("_l")) & (F.col("_chunk") == F.col("_c")))
    return joined.select(*stored.columns, (F.col("_base") + F.col("_in")).alias("_rank"))


def pack_documents(docs: DataFrame, vocabulary: str, max_length: int = 1024) -> DataFrame:
    """All documents packed: a row per piece with its sequence and offset, and the table of pieces stored once."""
    return pack(materialize(pieces(docs, vocabulary, max_length), "pieces"), max_length)
