"""Phrases whose words keep together, counted inside the distinct chunks of a prefix-free parse.

Texts are lower-cased (A-Z), split into pieces at punctuation and line ends, and pieces into words. A piece is parsed
into chunks: a chunk begins with the piece or where the hash of the next four words is 0 modulo 16, and ends with the
four words of the next such place, or with the piece. Chunks are thus fixed by their content, none is a proper prefix
of another that ends at a trigger, and neighbours overlap in exactly the four words of the trigger. A phrase of up to
five words lies whole in the chunk in whose own words (all but a closing trigger) it starts, and is counted there and
nowhere else. Equal chunks are one row of the dictionary with their number of occurrences: a copied text, line or
passage is cut up once, and its phrases are counted with that weight.

Counting goes level by level, as a phrase is never more frequent than its parts: words with their texts; then pairs of
frequent words by 64-bit keys alone; then triples of words whose pairs have a frequent key, likewise; then, with their
texts, phrases of two to five words all of whose pairs and triples have one. What is frequent goes to the tasks as bit
maps of a fixed size: a false hit costs a row that the final count by text drops; nothing frequent is ever missed. Maps
too small for a corpus only make more rows. Every count is by the texts of phrases, so keys that collide change nothing.
A block of chunks is one array of bytes: words are ranges of it, hashed by prefix sums, and only phrases that
leave the task become texts.

Scores are exact: decimals of 38 digits, good for 10 ** 16 words per language. A candidate inside a longer one that is
as frequent is dropped; if any longer candidate is, then one that is longer by a word is.

Null texts are empty; a null lang is `und`. Extra columns are ignored; rows of one id all count. A text is cut up in
blocks of about a megabyte at piece ends. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contractframe.llm.common import batches, discard, ground, materialize, ship_package, slices
from contractframe.llm.words import HIGH, LOW, mixed, range_hashes, rolling

LONGEST = 5
OVERLAP = LONGEST - 1  # words of a trigger: a longest phrase that starts before it ends inside it
TRIGGER = 16  # one place in so many starts a chunk
FILTER_BITS = 26  # three bit maps of 2 ** 26 bits, 8 MB each
_BLOCK, _ROWS, _HELD = 1 << 20, 100_000, 250_000

#: What ends a piece; words end at these or at spaces and tabs.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_MARK = b"\xff"  # in no UTF-8 text
_TABLE = bytes.maketrans(_ENDS + bytes(range(65, 91)), _MARK * len(_ENDS) + bytes(range(97, 123)))


# -- words as ranges of bytes --------------------------------------------------------------

_SPACE = 32


# -- the parse ---------------------------------------------------------------------------


def _blocks(texts: list[str | None]) -> Iterator[bytes]:
    """Marked bytes of the texts, in blocks that end where pieces do."""
    held, size = [], 0
    for text in texts:
        raw = (text or "").encode().translate(_TABLE)
        at = 0
        while len(raw) - at > 2 * _BLOCK:
            end = raw.find(_MARK, at + _BLOCK) + 1
            if not end:
                break
            yield raw[at:end]
            at = end
        held.append(raw[at:])
        size += len(raw) - at
        if size > _BLOCK:
            yield _MARK.join(held)
            held, size = [], 0
    if held:
        yield _MARK.join(held)


def chunks_of(block: bytes) -> Counter:
    """(chunk, closed by a trigger) -> occurrences."""
    text = b" ".join([*block.replace(_MARK, b" \xff ").split(), _MARK])
    data = np.frombuffer(text, "uint8")
    ends = np.append(np.flatnonzero(data == _SPACE), len(data))
    first = np.concatenate([[0], ends[:-1] + 1])
    mark = data[first] == 0xFF
    hashes = range_hashes(data, first, ends - first, 0)
    n = len(first)
    before = np.concatenate([[0], np.cumsum(mark)])  # marks before each place
    begins = np.concatenate([[True], mark[:-1]]) & ~mark  # first words of pieces
    trigger = np.zeros(n, bool)
    if n > OVERLAP:
        keys = mixed(rolling(hashes, OVERLAP, LOW)) % np.uint64(TRIGGER) == 0
        trigger[: len(keys)] = keys & (before[OVERLAP:][: len(keys)] == before[: len(keys)])
    starts = np.flatnonzero(begins | trigger)
    if not len(starts):
        return Counter()
    marks = np.flatnonzero(mark)
    piece_end = marks[np.searchsorted(marks, starts)]
    following = np.append(starts[1:], n)
    closed = following < piece_end
    stops = ends[np.where(closed, following + OVERLAP, piece_end) - 1]
    return Counter((text[a:b], c) for a, b, c in zip(first[starts].tolist(), stops.tolist(), closed.tolist()))


def chunk_dictionary(docs: DataFrame) -> DataFrame:
    """lang, chunk, closed and n: the distinct chunks of the texts of each language and how often they occur."""
    ship_package(docs.sparkSession)
    narrow = ground(docs, lang=F.coalesce("lang", F.lit("und")), text=F.coalesce("text", F.lit("")))

    def parse(data):
        for whole in data:
            for batch in slices(whole, "text", 1 << 23):
                by_lang = defaultdict(list)
                for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                    by_lang[lang].append(text)
                for lang, texts in by_lang.items():
                    found = Counter()
                    for block in _blocks(texts):
                        found.update(chunks_of(block))
                    yield from _pieces({
                        "lang": (pa.array([lang], pa.string()).take(pa.array(np.zeros(len(found), "int32"))), None),
                        "chunk": (pa.array([c for c, _ in found], pa.binary()).cast(pa.string()), None),
                        "closed": ([c for _, c in found], pa.bool_()),
                        "n": (list(found.values()), pa.int64()),
                    })

    parsed = narrow.mapInArrow(parse, "lang string, chunk string, closed boolean, n bigint")
    return parsed.groupBy("lang", "chunk", "closed").agg(F.sum("n").alias("n"))


def _pieces(columns: dict) -> Iterator[pa.RecordBatch]:
    """Rows out in batches that the JVM takes up in turn."""
    whole = batches(columns)
    for at in range(0, whole.num_rows, 20_000):
        yield whole.slice(at, 20_000)


# -- counting inside chunks ---------------------------------------------------------------


class BitMap:
    """Keys that may be frequent: two places of each in a map of fixed size."""

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, np.uint64(len(words) * 64 - 1)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        one = np.uint64(1)
        out = np.ones(len(keys), bool)
        for place in (keys & self.mask, (keys >> np.uint64(32)) & self.mask):
            out &= (self.words[(place >> np.uint64(6)).astype("int64")] >> (place & np.uint64(63))) & one == one
        return out


def _bit_map(keys: DataFrame, bits: int):
    """A broadcast map of these keys. At most 2 ** bits bits reach the driver, whatever the corpus."""
    mask = (1 << bits) - 1
    places = keys.select(F.explode(F.array(F.col("key").bitwiseAND(mask), F.shiftrightunsigned("key", 32).bitwiseAND(mask))).alias("place"))
    rows = places.groupBy(F.shiftright("place", 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(place & 63 AS int)))").alias("bits"))
    words = np.zeros(max(1, 1 << (bits - 6)), "uint64")
    found = rows.toArrow()
    words[found["at"].to_numpy()] = found["bits"].to_numpy().view("uint64")
    return keys.sparkSession.sparkContext.broadcast(words)


class Block:
    """Chunks of a dictionary side by side, with what is needed to count their phrases."""

    def __init__(self, langs: pa.Array, chunks: pa.Array, closed: np.ndarray, n: np.ndarray):
        offsets = np.frombuffer(chunks.buffers()[1], "int32")[chunks.offset : chunks.offset + len(chunks) + 1].astype("int64")
        raw = chunks.buffers()[2]
        self.text = memoryview(raw)[offsets[0] : offsets[-1]] if raw else memoryview(b"")
        offsets = offsets - offsets[0]
        data = np.frombuffer(self.text, "uint8")
        space = np.flatnonzero(data == _SPACE)
        # Chunks have single spaces between their words and none at their ends.
        self.first = np.sort(np.concatenate([offsets[:-1], space + 1]))
        self.stop = np.sort(np.concatenate([offsets[1:], space]))
        count = np.diff(np.searchsorted(self.first, offsets[:-1]), append=len(self.first))
        self.end = np.repeat(np.cumsum(count), count)  # place behind the chunk's last word
        place = np.arange(len(self.first))
        self.own = place < self.end - OVERLAP * np.repeat(closed, count)
        self.weight = np.repeat(n, count)
        length = self.stop - self.first
        self.low, self.high = range_hashes(data, self.first, length, 0), range_hashes(data, self.first, length, 1)
        coded = langs.dictionary_encode()
        self.names, self.lang = coded.dictionary, np.repeat(coded.indices.to_numpy(), count)
        self.salt = lang_salts(self.names.to_pylist())[self.lang]

    def keys(self, size: int) -> np.ndarray:
        """A key of language and words for every run of ``size`` words."""
        return mixed(rolling(self.low, size, LOW) * HIGH + self.salt[: max(0, len(self.low) - size + 1)] + np.uint64(size))

    def inside(self, size: int) -> np.ndarray:
        """Runs of ``size`` words that end inside their chunk."""
        n = max(0, len(self.first) - size + 1)
        return np.arange(size, size + n) <= self.end[:n]

    def all_parts(self, good: np.ndarray, parts: int, size: int) -> np.ndarray:
        """Runs of ``size`` words all of whose runs of ``parts`` words are good."""
        n, out = max(0, len(self.first) - size + 1), None
        for i in range(size - parts + 1):
            here = good[i : i + n]
            out = here if out is None else out & here
        return out

    def counted(self, size: int, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys and counts of the good runs that start among a chunk's own words."""
        at = np.flatnonzero(good & self.own[: len(good)])
        return _summed(self.keys(size)[at], self.weight[at])[:2]

    def phrases(self, size: int, good: np.ndarray | None = None) -> dict:
        """The good phrases of ``size`` words, and how often they occur, as columns."""
        good = self.inside(size) if good is None else good
        at = np.flatnonzero(good & self.own[: len(good)])
        keys, counts, first = _summed(self.keys(size)[at], self.weight[at])
        other = rolling(self.high, size, HIGH)
        # Keys of 64 bits that stand for two phrases here: count such a block place by place.
        if len(at) and (other[at] != other[at[first[0]]][first[1]]).any():
            counts, places = self.weight[at], at
        else:
            places = at[first[0]] if len(at) else at
        begin, end = self.first[places], self.stop[places + size - 1]
        text = self.text
        texts = [bytes(text[a:b]) for a, b in zip(begin.tolist(), end.tolist())]
        return {
            "lang": (self.names.take(pa.array(self.lang[places])), None),
            "phrase": (pa.array(texts, pa.binary()).cast(pa.string()), None),
            "n": (counts, pa.int64()),
        }


def lang_salts(names: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(name) for name in names] or [0], "uint64")


def phrase_keys(langs: pa.Array, phrases: pa.Array) -> np.ndarray:
    """The keys of single words, as a block gives them."""
    block = Block(langs, phrases, np.zeros(len(phrases), bool), np.ones(len(phrases), "int64"))
    return block.keys(1)


def _summed(keys: np.ndarray, weights: np.ndarray):
    """Distinct keys, their summed weights, and (first place of each, key number of each place)."""
    if not len(keys):
        return keys, weights, (np.zeros(0, "int64"), np.zeros(0, "int64"))
    distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
    sums = np.zeros(len(distinct), "int64")
    np.add.at(sums, inverse, weights)
    return distinct, sums, (first, inverse)


def _dictionary_blocks(data: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    held, rows, size = [], 0, 0

    def block():
        table = pa.Table.from_batches(held).combine_chunks()
        one = lambda name: table.column(name).combine_chunks()
        whole = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in (one("lang"), one("chunk"), one("closed"), one("n"))]
        return Block(whole[0].cast(pa.string()), whole[1].cast(pa.string()), whole[2].to_numpy(zero_copy_only=False), whole[3].to_numpy())

    for batch in data:
        held.append(batch)
        rows += batch.num_rows
        size += batch.nbytes
        if rows >= _ROWS or size >= 8 * _BLOCK:
            yield block()
            held, rows, size = [], 0, 0
    if rows:
        yield block()


def _combined(counts: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    """Phrase counts of a task's blocks added up, as long as that many distinct ones fit."""
    held, rows = [], 0

    def added_up():
        table = pa.Table.from_batches(held).group_by(["lang", "phrase"], use_threads=False).aggregate([("n", "sum")])
        return pa.table({"lang": table.column("lang"), "phrase": table.column("phrase"), "n": table.column("n_sum")})

    for columns in counts:
        held.append(batches(columns))
        rows += held[-1].num_rows
        if rows > 2 * _HELD:
            table = added_up()
            held, rows = table.to_batches(), table.num_rows
            if rows > _HELD:
                yield from table.to_batches(max_chunksize=20_000)
                held, rows = [], 0
    if rows:
        yield from added_up().to_batches(max_chunksize=20_000)


_PHRASES, _KEYS = "lang string, phrase string, n bigint", "key bigint, n bigint"


def phrase_counts(dictionary: DataFrame, min_count: int, filter_bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """Words per language, and lang, phrase, words and n of all words and phrases that occur ``min_count`` times."""

    def count_words(data):
        yield from _combined(block.phrases(1) for block in _dictionary_blocks(data))

    def word_keys(data):
        for batch in data:
            if batch.num_rows:
                keys = phrase_keys(batch.column("lang").cast(pa.string()), batch.column("phrase").cast(pa.string()))
                yield batches({"key": (keys.view("int64"), None)})

    def keyed(block, size, good):
        keys, counts = block.counted(size, good)
        yield from _pieces({"key": (keys.view("int64"), None), "n": (counts, pa.int64())})

    def count_pairs(data):
        words = BitMap(frequent_words.value)
        for block in _dictionary_blocks(data):
            good = words.holds(block.keys(1))
            yield from keyed(block, 2, block.inside(2) & block.all_parts(good, 1, 2))

    def count_triples(data):
        pairs = BitMap(frequent_pairs.value)
        for block in _dictionary_blocks(data):
            good = pairs.holds(block.keys(2)) & block.inside(2)
            yield from keyed(block, 3, block.inside(3) & block.all_parts(good, 2, 3))

    def phrases_of(data):
        pairs, triples = BitMap(frequent_pairs.value), BitMap(frequent_triples.value)
        for block in _dictionary_blocks(data):
            good = pairs.holds(block.keys(2)) & block.inside(2)
            yield block.phrases(2, good)
            good = block.inside(3) & block.all_parts(good, 2, 3)
            good[good] = triples.holds(block.keys(3)[good])
            for size in range(3, LONGEST + 1):
                yield block.phrases(size, block.inside(size) & block.all_parts(good, 3, size))

    def count_phrases(data):
        yield from _combined(phrases_of(data))

    often = F.col("n") >= min_count
    total = lambda rows, *by: rows.groupBy(*by).agg(F.sum("n").alias("n"))
    all_words = materialize(total(dictionary.mapInArrow(count_words, _PHRASES), "lang", "phrase"), "word-counts")
    totals = materialize(all_words.groupBy("lang").agg(F.sum("n").alias("n_words")), "words-per-language")
    words = all_words.where(often)
    frequent_words = _bit_map(words.select("lang", "phrase").mapInArrow(word_keys, "key bigint"), filter_bits)
    frequent_pairs = _bit_map(total(dictionary.mapInArrow(count_pairs, _KEYS), "key").where(often), filter_bits)
    frequent_triples = _bit_map(total(dictionary.mapInArrow(count_triples, _KEYS), "key").where(often), filter_bits)
    phrases = total(dictionary.mapInArrow(count_phrases, _PHRASES), "lang", "phrase").where(often)
    counts = words.unionByName(phrases).withColumn("words", F.size(F.split("phrase", " ")))
    counts = materialize(counts, "phrase-counts")
    discard(all_words)
    for sent in (frequent_words, frequent_pairs, frequent_triples):
        sent.destroy()
    return totals, counts


def _scored(totals: DataFrame, counts: DataFrame) -> DataFrame:
    """Candidates with the cut that scores lowest."""
    candidates = counts.where("words > 1").join(totals, "lang")
    ws = F.split("phrase", " ")
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "lang", "phrase", "words", F.col("n").alias("a"), F.col("n_words").alias("n"), "k",
        F.array_join(F.slice(ws, F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice(ws, F.col("k") + 1, F.col("words")), " ").alias("rest"),
    )
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    rests = counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    cuts = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"])
    wide = lambda c: f"cast({c} AS decimal(16, 0))"
    cuts = cuts.withColumn("score", F.expr(f"({wide('a')} * {wide('n')} * 1000) div ({wide('l')} * {wide('r')})"))
    return cuts.groupBy("lang", "phrase", "words", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select(
        "lang", "phrase", "words", "a", "n", "cut.l", "cut.r", "cut.score"
    )


def collocations(docs: DataFrame, min_count: int = 100, top: int = 2000, filter_bits: int = FILTER_BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language."""
    dictionary = materialize(chunk_dictionary(docs), "chunks")
    totals, counts = phrase_counts(dictionary, min_count, filter_bits)
    discard(dictionary)
    ws = F.split("phrase", " ")
    shorter = F.array(F.array_join(F.slice(ws, F.lit(1), F.col("words") - 1), " "), F.array_join(F.slice(ws, F.lit(2), F.col("words") - 1), " "))
    around = counts.where("words > 2").select("lang", F.explode(shorter).alias("phrase"), F.col("n").alias("n_longer"))
    around = around.groupBy("lang", "phrase").agg(F.max("n_longer").alias("n_longer"))
    kept = _scored(totals, counts).join(around, ["lang", "phrase"], "left").where("n_longer IS NULL OR n_longer < a")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
