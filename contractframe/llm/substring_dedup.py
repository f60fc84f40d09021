"""Removing repeated word sequences by a compacted de Bruijn graph of word k-mers.

The graph's edges are the windows of ``window`` words. They are never shuffled one by one: each window
picks an anchor, the smallest-hashed run of ``ANCHOR`` words in it, and neighbouring windows of a document
with one anchor form a path, about one per fourteen words. Equal windows pick equal anchors, so:

1. Paths whose anchor occurs once in the corpus hold no repeated window and go.
2. An anchor with one path content is a nonbranching stretch: the path is repeated as a whole or not at all.
3. At branching anchors, paths of equal content are repeated as a whole; the others are taken back to
   their source coordinates, where each window is hashed by its full words, and windows that occur twice
   anywhere in the branch are kept.

Compacted paths and kept windows of a document, given as coordinates, cover the words to remove.
Anchors are joined and summed with partial aggregates first; rows of one anchor meet only small tables in
joins that adaptive execution can split. Hashes have 128 bits.

Defined results: a null text has no words; a document shorter than the window loses none; equal rows repeat
each other; rows of one id and text share their result; null ids stay null; an empty table gives no rows;
other input columns are ignored (``cut_documents`` keeps them).
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contractframe.llm.common import batches, discard, ground, materialize, row_key, ship_package, slices
from contractframe.llm.words import HIGH, LOW, RangeHash, mixed, rolling, word_hashes

ANCHOR = 8  # words of an anchor; windows must be longer
_BLOCK = 1 << 21  # words worked on at once; blocks of one text overlap by a window


def _corpus(texts: list[str | None]):
    """Words of all texts in a row, and the bounds of each text in it."""
    lists = [t.encode().split() if t else [] for t in texts]
    bounds = np.cumsum([0, *map(len, lists)])
    return [w for words in lists for w in words], bounds


def _paths(low, high, owner, window: int):
    """Paths of one block: (first window, windows, anchor hash, content hash)."""
    span = window - ANCHOR + 1
    keys = mixed(rolling(low, ANCHOR, LOW))
    n = len(keys) - span + 1
    if n <= 0:
        return (np.zeros(0, "int64"),) * 2 + (np.zeros(0, "uint64"),) * 2
    # The leftmost of the smallest: positions in the low bits break ties by place.
    least = (keys & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(keys), dtype="uint64")
    width = 1
    while 2 * width <= span:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    least = np.minimum(least[:n], least[span - width : span - width + n])
    place = (least & np.uint64(0xFFFFFF)).astype("int64")
    inside = owner[:n] == owner[window - 1 :]
    change = np.concatenate([[True], (place[1:] != place[:-1]) | (owner[1:n] != owner[: n - 1])])
    starts = np.flatnonzero(change)
    counts = np.diff(np.append(starts, n))
    # A run that leaves its document ends with the last window inside it.
    good = np.add.reduceat(inside.astype("int64"), starts)
    starts, good = starts[good > 0], good[good > 0]
    content = RangeHash(high, HIGH).of(starts, good + window - 1)
    return starts, good, keys[place[starts]], mixed(content + good.astype("uint64"))


def document_paths(narrow: DataFrame, window: int) -> DataFrame:
    """doc_id, _k, first, n, anchor, content: the paths of every document."""
    import pyarrow as pa

    ship_package(narrow.sparkSession)

    def cut(stream):
        for batch in stream:
            for part in slices(batch, "text"):
                words, bounds = _corpus(part.column("text").to_pylist())
                if len(words) < window:
                    continue
                owner = np.repeat(np.arange(part.num_rows), np.diff(bounds))
                found = []
                for at in range(0, len(words), _BLOCK):
                    end = min(len(words), at + _BLOCK + window - 1)
                    hashes = word_hashes(words[at:end])
                    first, n, anchor, content = _paths(hashes[0], hashes[1], owner[at:end], window)
                    found.append((first + at, n, anchor, content))
                first, n, anchor, content = (np.concatenate(x) for x in zip(*found))
                own = owner[first]
                yield batches({
                    "doc_id": (part.column("doc_id").take(pa.array(own)), None), "_k": (part.column("_k").take(pa.array(own)), None),
                    "first": (pa.array(first - bounds[own]), None), "n": (pa.array(n.astype("int32")), None),
                    "anchor": (pa.array(anchor.view("int64")), None), "content": (pa.array(content.view("int64")), None),
                })

    return narrow.mapInArrow(cut, "doc_id bigint, _k bigint, first bigint, n int, anchor bigint, content bigint")


def _coded(first, n, many):
    """A range of windows in one number."""
    return F.shiftleft(first, 16) + F.shiftleft(n.cast("bigint"), 1) + many.cast("bigint")


def _per_document(ranges: DataFrame) -> DataFrame:
    """All ranges of a document in one array, which its number of words bounds."""
    return ranges.groupBy(F.col("doc_id").alias("_d"), F.col("_k").alias("_t")).agg(F.collect_list("code").alias("codes"))


def _with_ranges(narrow: DataFrame, ranges: DataFrame, how: str) -> DataFrame:
    per = _per_document(ranges)
    return narrow.join(per, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_k") == F.col("_t")), how).drop("_d", "_t")


def _branch_windows(narrow: DataFrame, branching: DataFrame, window: int) -> DataFrame:
    """doc_id, _k, first, many, h1, h2: each window of the given paths, hashed by its words at its source."""
    import pyarrow as pa

    def cut(stream):
        for batch in stream:
            for part in slices(batch, "text"):
                for i in range(part.num_rows):
                    words = part.column("text")[i].as_py().encode().split()
                    codes = part.column("codes")[i].values.to_numpy()
                    first, n, many = codes >> 16, (codes >> 1) & 0x7FFF, codes & 1
                    hashes = word_hashes(words)
                    at = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    doc, key = part.column("doc_id")[i].as_py(), part.column("_k")[i].as_py()
                    yield batches({
                        "doc_id": ([doc] * len(at), pa.int64()), "_k": ([key] * len(at), pa.int64()),
                        "first": (pa.array(at), None), "many": (pa.array(np.repeat(many, n).astype("int32")), None),
                        "h1": (pa.array(RangeHash(hashes[0], LOW).of(at, window).view("int64")), None),
                        "h2": (pa.array(RangeHash(hashes[1], HIGH).of(at, window).view("int64")), None),
                    })

    asked = branching.select("rep.doc_id", "rep._k", _coded(F.col("rep.first"), F.col("n"), F.col("c") > 1).alias("code"))
    return _with_ranges(narrow, asked, "inner").mapInArrow(cut, "doc_id bigint, _k bigint, first bigint, many int, h1 bigint, h2 bigint")


def repeated_ranges(narrow: DataFrame, window: int) -> DataFrame:
    """doc_id, _k, code: ranges of windows whose words occur elsewhere too."""
    paths = materialize(document_paths(narrow, window), "paths")
    met = materialize(paths.groupBy("anchor").agg(F.count("*").alias("_n")).where("_n > 1").select(F.col("anchor").alias("_a")), "anchors")
    shared = materialize(paths.join(met, F.col("anchor") == F.col("_a")).drop("_a"), "shared-paths")
    discard(paths)
    contents = materialize(
        shared.groupBy("anchor", "content", "n").agg(F.count("*").alias("c"), F.min(F.struct("doc_id", "_k", "first")).alias("rep")), "path-contents"
    )
    forks = materialize(contents.groupBy("anchor").agg(F.count("*").alias("_n")).where("_n > 1").select(F.col("anchor").alias("_a")), "forks")
    branching = contents.join(forks, F.col("anchor") == F.col("_a")).drop("_a")
    windows = materialize(_branch_windows(narrow, branching, window), "branch-windows")
    twice = windows.groupBy("h1", "h2").agg(F.sum(F.col("many") + 1).alias("_n")).where("_n > 1")
    twice = materialize(twice.select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2")), "repeated-windows")
    whole = contents.where("c > 1").select(F.col("anchor").alias("_a"), F.col("content").alias("_c"), F.col("n").alias("_m"))
    compacted = shared.join(whole, (F.col("anchor") == F.col("_a")) & (F.col("content") == F.col("_c")) & (F.col("n") == F.col("_m")))
    single = windows.where("many = 0").join(twice, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")))
    ranges = compacted.select("doc_id", "_k", _coded(F.col("first"), F.col("n"), F.lit(False)).alias("code")).unionByName(
        single.select("doc_id", "_k", _coded(F.col("first"), F.lit(1), F.lit(False)).alias("code"))
    )
    ranges = materialize(ranges, "ranges")
    discard(met, shared, contents, forks, windows, twice)
    return ranges


def _kept(words: list[bytes], codes: np.ndarray | None, window: int) -> list[bytes]:
    if codes is None or not len(codes):
        return words
    first, n = codes >> 16, (codes >> 1) & 0x7FFF
    cover = np.zeros(len(words) + 1, "int64")
    np.add.at(cover, first, 1)
    np.add.at(cover, first + n + window - 1, -1)
    hit = np.cumsum(cover[:-1]) > 0
    return [words[i] for i in np.flatnonzero(~hit)]


def _narrow(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return ground(docs, doc_id=F.col(id_column).cast("bigint"), text=F.col(text_column), _k=row_key(F.col(text_column)))


def dedup_report(docs: DataFrame, window: int = 35, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space)."""
    import pyarrow as pa

    def judge(stream):
        for batch in stream:
            for part in slices(batch, "text"):
                total, gone, digest = [], [], []
                for text, codes in zip(part.column("text").to_pylist(), part.column("codes")):
                    words = text.encode().split() if text else []
                    left = _kept(words, codes.values.to_numpy() if codes.is_valid else None, window)
                    total.append(len(words))
                    gone.append(len(words) - len(left))
                    digest.append(hashlib.sha256(b" ".join(left)).hexdigest())
                yield batches({
                    "doc_id": (part.column("doc_id"), None), "n_words": (total, pa.int64()),
                    "n_removed": (gone, pa.int64()), "kept_sha256": (digest, pa.string()),
                })

    narrow = _narrow(docs, id_column, text_column)
    told = _with_ranges(narrow, repeated_ranges(narrow, window), "left").select("doc_id", "text", "codes")
    return told.mapInArrow(judge, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")


def cut_documents(docs: DataFrame, window: int = 35, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents, all columns, with repeated words cut from their texts; a text without any stays as it is."""
    import pyarrow as pa

    narrow = _narrow(docs, id_column, text_column)
    per = _per_document(repeated_ranges(narrow, window)).withColumnsRenamed({"_d": "_dedup_id", "_t": "_dedup_text", "codes": "_dedup_codes"})
    joined = docs.join(
        per, docs[id_column].cast("bigint").eqNullSafe(F.col("_dedup_id")) & (row_key(docs[text_column]) == F.col("_dedup_text")), "left"
    )

    def cut(stream):
        for batch in stream:
            for part in slices(batch, text_column):
                texts = [
                    text if text is None or not codes.is_valid else b" ".join(_kept(text.encode().split(), codes.values.to_numpy(), window)).decode()
                    for text, codes in zip(part.column(text_column).to_pylist(), part.column("_dedup_codes"))
                ]
                at = part.schema.get_field_index(text_column)
                yield part.set_column(at, part.schema.field(at), pa.array(texts, part.schema.field(at).type)).drop_columns(["_dedup_codes"])

    return joined.select(*[docs[c] for c in docs.columns], "_dedup_codes").mapInArrow(cut, docs.schema)
