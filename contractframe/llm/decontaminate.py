"""Benchmark passages in documents by a prefix-filtered join of word shingles, in DataFrame functions alone.

An item's windows are its runs of ``window`` words (a shorter item is one window). A document holds a window
if all the window's shingles of three words stand at the right places, so any one of them is a necessary
token; the prefix is the rarest, as counted over all documents:

1. Document shingles meet the shingles of the benchmark: what matches is the only thing kept of a document.
   The benchmark's table is stored first, so Spark broadcasts it below the session's measured threshold
   and otherwise joins by shuffle.
2. Each window is looked up by its rarest shingle; a window with a shingle that no document has is dropped.
3. Candidates outside the document's bounds go; the others are verified by all their shingles, word for
   word and place by place. Shingles are compared as words, never by hash alone.

Defined results: case of A to Z is ignored; null and empty texts have no words, and an item without words no
window; equal items and windows are found once, an item counts by its id, and an item without an id marks
words but is not counted; equal rows get equal results; empty tables give no rows or no hits; other input
columns are ignored (``clean_documents`` keeps them).
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contractframe.llm.common import ground, materialize, row_key

SHINGLE = 3
#: ASCII characters that no word holds; every other one, and all beyond ASCII, are parts of words.
_BETWEEN = "".join(chr(i) for i in range(128) if chr(i) not in string.ascii_letters + string.digits)


def words_of(text: Column) -> Column:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text, A to Z lower-cased; none for null.

    One pass lowers letters and blanks out what is between words, which costs half of matching a pattern.
    """
    plain = F.translate(text, string.ascii_uppercase + _BETWEEN, string.ascii_lowercase + " " * len(_BETWEEN))
    return F.coalesce(F.array_remove(F.split(plain, " "), ""), F.array().cast("array<string>"))


def _windows(items: DataFrame, window: int, id_column: str, text_column: str) -> DataFrame:
    """item_id, window (its words joined by a space), size."""
    words = items.select(F.col(id_column).cast("string").alias("item_id"), words_of(F.col(text_column)).alias("words"))
    some = words.where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - window + 1))
    each = some.select("item_id", "words", F.explode(starts).alias("at")).select("item_id", F.slice("words", F.col("at"), window).alias("words"))
    return each.select("item_id", F.concat_ws(" ", "words").alias("window"), F.size("words").alias("size"))


def _window_shingles(windows: DataFrame) -> DataFrame:
    """window, size, off, shingle: every run of three words of a window, or all of a shorter one."""
    words = F.split("window", " ")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("size") - SHINGLE + 1))
    each = windows.select("window", "size", words.alias("words"), F.explode(starts).alias("at"))
    return each.select("window", "size", (F.col("at") - 1).alias("off"), F.concat_ws(" ", F.slice("words", F.col("at"), SHINGLE)).alias("shingle"))


def _document_hits(narrow: DataFrame, shingles: DataFrame) -> DataFrame:
    """doc_id, _k, n_words, pos, shingle: where documents have the hash of a benchmark's shingle."""
    sizes = sorted(r["size"] for r in shingles.select("size").distinct().collect()) or [SHINGLE]  # one to three
    words = narrow.select("doc_id", "_k", words_of(F.col("text")).alias("words"))
    n = F.size("words")
    columns = [F.col("words"), *[F.slice("words", F.lit(i), n) for i in range(2, SHINGLE + 1)]]
    zipped = F.arrays_zip(*[c.alias(f"w{i}") for i, c in enumerate(columns)])
    # No filter on the words here: it would be moved below, where texts would be cut twice.
    places = words.select("doc_id", "_k", n.alias("n_words"), F.posexplode(zipped).alias("pos", "w"))
    ws = [F.col("w")[f"w{i}"] for i in range(SHINGLE)]
    if sizes == [SHINGLE]:
        keyed = places.where(ws[-1].isNotNull()).select("doc_id", "_k", "n_words", "pos", *[w.alias(f"w{i}") for i, w in enumerate(ws)])
    else:
        runs = F.array(*[F.struct(*[(ws[i] if i < s else F.lit("")).alias(f"w{i}") for i in range(SHINGLE)]) for s in sizes])
        keyed = places.select("doc_id", "_k", "n_words", "pos", F.explode(runs).alias("r")).select("doc_id", "_k", "n_words", "pos", "r.*").where(f"w{SHINGLE - 1} IS NOT NULL")
    names = [f"w{i}" for i in range(SHINGLE)]
    # Only hashes meet here, a number each; the words go along and are compared where the hits are used.
    met = keyed.withColumn("_hash", F.xxhash64(*names)).join(shingles.select(F.col("hash").alias("_h")), F.col("_hash") == F.col("_h"))
    return met.select("doc_id", "_k", "n_words", "pos", F.concat_ws(" ", *[F.nullif(F.col(w), F.lit("")) for w in names]).alias("shingle"))


def occurrences(narrow: DataFrame, windows: DataFrame) -> DataFrame:
    """doc_id, _k, window, size, start: every place where a document holds a window."""
    parts = materialize(_window_shingles(windows.select("window", "size").distinct()), "window-shingles")
    words = F.split("shingle", " ")
    hashed = F.xxhash64(*[F.coalesce(F.get(words, F.lit(i)), F.lit("")) for i in range(SHINGLE)])
    shingles = materialize(parts.select(F.size(words).alias("size"), hashed.alias("hash")).distinct(), "shingles")
    # Equal rows of the table are looked at once.
    hits = materialize(_document_hits(narrow, shingles).dropDuplicates(["doc_id", "_k", "pos", "shingle"]), "shingle-hits")
    rarity = hits.groupBy("shingle").agg(F.count("*").alias("_seen"))
    ranked = parts.join(rarity, "shingle", "left").groupBy("window", "size").agg(
        F.min(F.struct(F.coalesce("_seen", F.lit(0)).alias("seen"), "off", "shingle")).alias("prefix"), F.count("*").alias("_parts")
    )
    prefix = ranked.where("prefix.seen > 0").select("window", "size", "_parts", F.col("prefix.off").alias("off"), F.col("prefix.shingle").alias("shingle"))
    prefix = materialize(prefix, "prefixes")
    met = hits.join(prefix, "shingle").withColumn("start", F.col("pos") - F.col("off"))
    bounded = met.where((F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.col("n_words")))
    candidates = bounded.select("doc_id", "_k", "window", "size", "start", "_parts")
    asked = candidates.join(parts.select("window", "off", F.col("shingle").alias("_s")), "window").withColumn("_at", F.col("start") + F.col("off"))
    there = hits.select(F.col("doc_id").alias("_d"), F.col("_k").alias("_t"), F.col("pos").alias("_p"), F.col("shingle").alias("_own"))
    found = asked.join(
        there, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_k") == F.col("_t")) & (F.col("_at") == F.col("_p")) & (F.col("_s") == F.col("_own"))
    )
    verified = found.groupBy("doc_id", "_k", "window", "size", "start", "_parts").agg(F.count("*").alias("_found"))
    return verified.where("_found = _parts").select("doc_id", "_k", "window", "size", "start")


def _hits(narrow: DataFrame, items: DataFrame, window: int, item_id: str, item_text: str) -> DataFrame:
    """_d, _t, n_hit, item_ids: a row per document with any hit."""
    windows = materialize(_windows(items, window, item_id, item_text).distinct(), "windows")
    found = materialize(occurrences(narrow, windows), "occurrences")
    before = Window.partitionBy("doc_id", "_k").orderBy("start", "size").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("size")
    spans = found.select("doc_id", "_k", "start", "size").distinct()
    fresh = F.greatest(F.lit(0), end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(before), F.lit(0))))
    covered = spans.select("doc_id", "_k", fresh.alias("fresh")).groupBy("doc_id", "_k").agg(F.sum("fresh").alias("n_hit"))
    owned = found.select("doc_id", "_k", "window").distinct().join(windows.select("window", "item_id").where("item_id IS NOT NULL"), "window")
    ids = owned.select("doc_id", "_k", "item_id").distinct().groupBy("doc_id", "_k").agg(F.array_sort(F.collect_list("item_id")).alias("item_ids"))
    ids = ids.select(F.col("doc_id").alias("_i"), F.col("_k").alias("_j"), "item_ids")
    both = covered.join(ids, F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("_k") == F.col("_j")), "left")
    return materialize(both.select(F.col("doc_id").alias("_d"), F.col("_k").alias("_t"), "n_hit", "item_ids"), "document-hits")


def contamination(
    docs: DataFrame, items: DataFrame, window: int = 10, *, id_column: str = "doc_id", text_column: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and the item_ids."""
    narrow = ground(docs, doc_id=F.col(id_column), text=F.col(text_column), _k=row_key(F.col(text_column)))
    hits = _hits(narrow, items, window, item_id, item_text)
    counted = narrow.select("doc_id", "_k", F.size(words_of(F.col("text"))).cast("bigint").alias("n_words"))
    told = counted.join(hits, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_k") == F.col("_t")), "left")
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return told.select(
        "doc_id", "n_words", F.coalesce(F.col("n_hit").cast("bigint"), F.lit(0).cast("bigint")).alias("n_hit"), F.size(ids).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"), ids.alias("item_ids"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, window: int = 10, *, id_column: str = "doc_id", text_column: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents, all columns, that hold no window of any item."""
    narrow = ground(docs, doc_id=F.col(id_column), text=F.col(text_column), _k=row_key(F.col(text_column)))
    hits = _hits(narrow, items, window, item_id, item_text).select("_d", "_t")
    hits = hits.withColumnsRenamed({"_d": "_hit_id", "_t": "_hit_text"})
    same = docs[id_column].eqNullSafe(F.col("_hit_id")) & (row_key(docs[text_column]) == F.col("_hit_text"))
    return docs.join(hits, same, "left_anti")
