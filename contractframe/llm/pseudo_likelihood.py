"""Masked pseudo-likelihood: a small window network, trained in numpy, predicts every word from both sides.

Each word is predicted from the ``SIDE`` words before and after it: hidden = tanh(sum of context embeddings,
each scaled by its place), then a two-level softmax, first the class of the word and then the word in it. A
document's score is the sum of the log-probabilities of all its words, each given the others around it.

The vocabulary is counted over the whole corpus: the ``TOP`` most frequent words, and ``RARE`` ids that the
other words share by hash. The network predicts ids; a word that shares its id has the probability
count(word) / count(id) within it, by the counts of all words, which stay a Spark table that each block's
distinct words are joined to (``own_words``; else the score is that of the ids). Texts are cut to words once, and
stored as blocks of documents: the distinct words of a block, and every word's number among them, which is what
counting, training and scoring read. Training is data-parallel over all
documents: the words of every document are dealt over the rounds, so that together they train on every word
once. In each round every task starts from the shared weights, trains on that round's words, and the weights are
averaged by the words they saw. A table of fixed size goes out and comes back, whatever the corpus.

Defined results: null and empty texts have no words, log_prob 0 and a null mean; the words past the ends of
a text are a mark of their own; null ids are kept; equal rows score alike; an empty table gives no rows; a
corpus without words leaves the weights as they began; other input columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contractframe.llm.common import batches, discard, ground, materialize, ship_package, slices

SIDE, WIDTH = 2, 32
TOP, RARE, CLASSES = 896, 128, 32
SIZE = TOP + RARE  # ids; SIZE itself marks what lies past an end
PER_CLASS = SIZE // CLASSES
ROUNDS, RATE, BATCH = 2, 0.08, 4096
_BLOCK = 12 << 20  # bytes of text in a block of documents
_MARKS = ".,;:!?"
_CACHE_WORDS = 200_000


def words_of(text: str | None) -> list[str]:
    """Words in lower case; the usual punctuation marks are words of their own."""
    if not text:
        return []
    text = text.lower()
    for mark in _MARKS:
        if mark in text:
            text = text.replace(mark, f" {mark} ")
    return text.split()


def _shared(word: str) -> int:
    """Which of the shared ids the word has."""
    return zlib.crc32(word.encode()) % RARE


class WordIds(dict):
    """word -> id: its frequency rank, or one of the shared ids."""

    def __init__(self, top: list[str]):
        super().__init__((w, i) for i, w in enumerate(top))
        self.top = top

    def __missing__(self, word):
        if len(self) > _CACHE_WORDS:
            self.clear()
            self.update((w, i) for i, w in enumerate(self.top))
        # Frequent words fill the first classes; ids of one class are neighbours in rank.
        value = self[word] = TOP + _shared(word)
        return value


class Codes(dict):
    """word -> its number among the distinct words met so far."""

    def __missing__(self, word):
        code = self[word] = len(self)
        return code

    def of(self, texts: list[str | None]) -> list[np.ndarray]:
        """The numbers of each text's words."""
        found = []
        for text in texts:
            words = words_of(text)
            found.append(np.fromiter(map(self.__getitem__, words), "int32", len(words)))
        return found


def start_weights(seed: int = 7) -> np.ndarray:
    """All weights as rows of WIDTH: embeddings, places, hidden bias, class and word outputs; last column of outputs is the bias."""
    rng = np.random.default_rng(seed)
    w = rng.normal(0, 0.1, (ROWS, WIDTH)).astype("float32")
    w[PLACES] = 1.0 / (2 * SIDE) ** 0.5
    w[HIDDEN] = 0
    w[CLASS_OUT] = w[WORD_OUT] = 0
    return w


EMBED = slice(0, SIZE + 1)
PLACES = slice(SIZE + 1, SIZE + 1 + 2 * SIDE)
HIDDEN = PLACES.stop
CLASS_OUT = slice(HIDDEN + 1, HIDDEN + 1 + CLASSES)
WORD_OUT = slice(CLASS_OUT.stop, CLASS_OUT.stop + SIZE)
ROWS = WORD_OUT.stop
_AROUND = np.array([*range(-SIDE, 0), *range(1, SIDE + 1)])[:, None]


class Network:
    """The network over one array of weights. The last hidden unit is always 1 and carries the biases."""

    def __init__(self, weights: np.ndarray):
        self.w = weights.astype("float32").copy()
        self.grad = np.zeros_like(self.w)  # sums of squares, for step sizes

    def hidden(self, context: np.ndarray) -> np.ndarray:
        """Of each column of ``context``, the words around a place."""
        z = None
        for around, place in zip(context, self.w[PLACES]):
            told = np.take(self.w[EMBED] * place, around, axis=0)
            z = np.add(told, self.w[HIDDEN], out=told) if z is None else np.add(z, told, out=z)
        h = np.tanh(z, out=z)
        h[:, -1] = 1
        return h

    def in_classes(self, h: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, slice]]]:
        """What each word of its target's class gets, a column for each place, and the run of places of each class.

        Targets are in order of their classes.
        """
        cuts = np.searchsorted(target // PER_CLASS, np.arange(CLASSES + 1)).tolist()
        runs = [(a, b, slice(WORD_OUT.start + c * PER_CLASS, WORD_OUT.start + (c + 1) * PER_CLASS)) for c, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
        x = np.empty((PER_CLASS, len(h)), "float32")
        for a, b, block in runs:
            x[:, a:b] = self.w[block] @ h[a:b].T
        return x, runs

    def log_probs(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """log P of the words at these places."""
        out = np.empty(len(at), "float64")
        for i in range(0, len(at), 8192):
            order = _by_class(ids[at[i : i + 8192]])
            place = at[i : i + 8192][order]
            h, target = self.hidden(ids[place + _AROUND]), ids[place]
            told = _log_softmax_at(self.w[CLASS_OUT] @ h.T, target // PER_CLASS)
            out[i + order] = told + _log_softmax_at(self.in_classes(h, target)[0], target % PER_CLASS).astype("float64")
        return out

    def train(self, ids: np.ndarray, at: np.ndarray) -> None:
        """One pass over these places, in batches, with step sizes by coordinate."""
        for i in range(0, len(at), BATCH):
            place = at[i : i + BATCH]
            place = place[_by_class(ids[place])]
            context, target = ids[place + _AROUND], ids[place]
            h = self.hidden(context)
            step = np.zeros_like(self.w)
            rows = np.arange(len(place))
            p = _softmax(self.w[CLASS_OUT] @ h.T)
            p[target // PER_CLASS, rows] -= 1
            step[CLASS_OUT] = p @ h
            back = p.T @ self.w[CLASS_OUT]
            x, runs = self.in_classes(h, target)
            q = _softmax(x)
            q[target % PER_CLASS, rows] -= 1
            for a, b, block in runs:
                step[block] = q[:, a:b] @ h[a:b]
                back[a:b] += q[:, a:b].T @ self.w[block]
            back *= 1 - h * h  # zero for the unit that is always 1
            step[HIDDEN] = back.sum(axis=0)
            for p, scale in enumerate(self.w[PLACES]):
                told = _sum_rows(context[p], back)
                step[PLACES][p] = (told * self.w[EMBED]).sum(axis=0)
                step[EMBED] += told * scale
            step /= len(place) ** 0.5
            self.grad += step * step
            self.w -= RATE * step / np.sqrt(self.grad + 1e-6)


def _sum_rows(ids: np.ndarray, values: np.ndarray, few: int = 4) -> np.ndarray:
    """The values of each id, summed; those of up to ``few`` places for all such ids at once."""
    out = np.zeros((SIZE + 1, values.shape[1]), values.dtype)
    order = np.argsort(ids.astype("uint16"), kind="stable")
    count = np.bincount(ids, minlength=SIZE + 1)
    first = np.cumsum(count) - count
    for n in range(1, few + 1):
        at = np.flatnonzero(count == n)
        if len(at):
            # Added up as reduceat does, so that the sums are the same to the last bit.
            each = [np.take(values, order[first[at] + k], axis=0) for k in (*range(1, n), 0)]
            for more in each[1:]:
                each[0] += more
            out[at] = each[0]
    often = np.flatnonzero(count > few)
    if len(often):
        places = order[np.repeat(count > few, count)]
        out[often] = np.add.reduceat(np.take(values, places, axis=0), np.cumsum(count[often]) - count[often], axis=0)
    return out


def _by_class(target: np.ndarray) -> np.ndarray:
    """An order of these ids by their classes."""
    return np.argsort((target // PER_CLASS).astype("uint8"), kind="stable")


def _softmax(x: np.ndarray) -> np.ndarray:
    """Of each column, in place."""
    x -= x.max(axis=0)
    np.exp(x, out=x)
    x /= x.sum(axis=0)
    return x


def _log_softmax_at(x: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The log-softmax of each column at one of its rows; changes ``x``."""
    x -= x.max(axis=0)
    own = x[row, np.arange(len(row))]
    return own - np.log(np.exp(x, out=x).sum(axis=0))


def blocks_of(narrow: DataFrame, most_bytes: int = _BLOCK) -> DataFrame:
    """The documents in blocks, stored: their ids and numbers of words, how many of them train together, the distinct
    words of the block with their counts, the number among these of each word, as bytes of 32-bit integers, and a byte
    for each of them, the shared id that it has unless it is frequent."""
    import pyarrow as pa

    kind = narrow.schema["doc_id"].dataType.simpleString()

    def parse(stream):
        ids, codes, cuts, known, size = [], [], [], Codes(), 0

        def block():
            each = np.concatenate([*codes, np.zeros(0, "int32")])
            listed = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            counts = pa.array(np.bincount(each, minlength=len(known)), pa.int64())
            return batches({
                "doc_ids": (listed(pa.concat_arrays(ids)), None),
                "lengths": (listed(pa.array([len(c) for c in codes], pa.int32())), None),
                "cuts": (listed(pa.array(cuts, pa.int32())), None),
                "words": (listed(pa.StructArray.from_arrays([pa.array(list(known), pa.string()), counts], ["word", "c"])), None),
                "codes": ([each.tobytes()], pa.binary()),
                "shared": ([bytes(map(_shared, known))], pa.binary()),
            })

        for batch in stream:
            for part in slices(batch, "text", min(most_bytes, 1 << 20)):
                ids.append(part.column("doc_id"))
                codes += known.of(part.column("text").to_pylist())
                cuts.append(part.num_rows)
                size += part.column("text").nbytes
                if size >= most_bytes:
                    yield block()
                    ids, codes, cuts, known, size = [], [], [], Codes(), 0
        if ids:
            yield block()

    columns = f"doc_ids array<{kind}>, lengths array<int>, cuts array<int>, words array<struct<word: string, c: bigint>>, codes binary, shared binary"
    return materialize(narrow.mapInArrow(parse, columns).withColumn("block", F.monotonically_increasing_id()), "blocks", rows_at_once=1)


def _blocks(stream, top: list[str] | None = None) -> Iterator[dict]:
    """The columns of each block; ``ids`` of its distinct words if the most frequent ones are given."""
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in stream:
        for i in range(batch.num_rows):
            row = {name: batch.column(name).slice(i, 1) for name in batch.schema.names}
            block = {name: row[name].flatten().to_numpy().astype("int64") for name in ("lengths", "cuts")}
            block |= {"codes": np.frombuffer(row["codes"][0].as_py(), "int32"), "doc_ids": row["doc_ids"].flatten() if "doc_ids" in row else None}
            if top is not None:
                words = row["words"].flatten()
                rank = pc.fill_null(pc.index_in(words, value_set=pa.array(top, words.type)), -1).to_numpy()
                block["ids"] = np.where(rank < 0, TOP + np.frombuffer(row["shared"][0].as_py(), "uint8").astype("int64"), rank)
            yield block


def _parts(block: dict, ids: np.ndarray):
    """Of each slice of a block: ids of all texts in a row with marks around each, numbers of words, and numbers of its words."""
    document = word = 0
    for n in block["cuts"].tolist():
        lengths = block["lengths"][document : document + n]
        codes = block["codes"][word : word + int(lengths.sum())]
        marked = np.full(len(codes) + 2 * SIDE * n, SIZE, "int64")
        marked[_places(marked, lengths)] = ids[codes]
        yield marked, lengths, codes
        document, word = document + n, word + len(codes)


def vocabulary(blocks: DataFrame) -> tuple[DataFrame, list[str]]:
    """How often each word occurs in all documents, stored, and the TOP most frequent ones; ties by the word itself."""
    counted = materialize(blocks.select(F.inline("words")).groupBy("word").agg(F.sum("c").alias("c")), "words")
    return counted, [r["word"] for r in counted.orderBy(F.desc("c"), "word").limit(TOP).collect()]


def word_ids(counted: DataFrame, top: list[str]) -> DataFrame:
    """id and log P(word | id), as ``own``, of every word; the most frequent words have ids of their own."""
    rare = counted.where(~F.col("word").isin(top)) if top else counted
    rare = rare.withColumn("id", (TOP + F.crc32(F.col("word").cast("binary")) % RARE).cast("int"))
    ids = rare.groupBy("id").agg(F.sum("c").alias("all"))
    rare = rare.join(F.broadcast(ids), "id").select("word", "id", F.log(F.col("c") / F.col("all")).alias("own"))  # RARE rows
    known = counted.sparkSession.createDataFrame([(w, i, 0.0) for i, w in enumerate(top)], "word string, id int, own double")
    return rare.unionByName(known)


def _places(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Where the words are among ids and marks."""
    first = np.cumsum(lengths + 2 * SIDE) - lengths - SIDE
    return np.repeat(first - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


def _dealt(lengths: np.ndarray, turn: int, rounds: int) -> np.ndarray:
    """Which words a round learns: of each document every ``rounds``-th, so that all rounds learn all words."""
    place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return (place + np.repeat(lengths, lengths)) % rounds == turn


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The values of each document, summed."""
    ends = np.cumsum(lengths)
    sums = np.concatenate([[0.0], np.cumsum(values)])
    return sums[ends] - sums[ends - lengths]


def train(blocks: DataFrame, top: list[str], rounds: int = ROUNDS) -> np.ndarray:
    """Weights after rounds of training in all tasks and averaging; ROWS rows come to the driver each round."""
    import pyarrow as pa

    spark = blocks.sparkSession
    weights = start_weights()
    columns = [f"c{i}" for i in range(WIDTH)]
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast((top, weights))

        def learn(stream, turn=turn, shared=shared):
            top, start = shared.value
            network, seen = Network(start), 0
            for block in _blocks(stream, top):
                for ids, lengths, _ in _parts(block, block["ids"]):
                    at = _places(ids, lengths)[_dealt(lengths, turn, rounds)]
                    if len(at):
                        network.train(ids, np.random.default_rng(turn).permutation(at))
                        seen += len(at)
            if seen:
                yield batches({
                    "row": (pa.array(np.arange(ROWS)), None), "seen": (pa.array(np.full(ROWS, seen)), None),
                    **{c: (pa.array(network.w[:, i].astype("float64") * seen), None) for i, c in enumerate(columns)},
                })

        told = blocks.select("lengths", "cuts", "codes", "shared", F.col("words.word").alias("words")).mapInArrow(learn, "row bigint, seen bigint, " + ", ".join(f"{c} double" for c in columns))
        mean = told.groupBy("row").agg(*[(F.sum(c) / F.sum("seen")).alias(c) for c in columns]).toArrow()
        if mean.num_rows:
            weights = np.zeros_like(weights)
            weights[mean.column("row").to_numpy()] = np.column_stack([mean.column(c).to_numpy() for c in columns])
    return weights


def score_documents(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rounds: int = ROUNDS, own_words: bool = False,
) -> DataFrame:
    """Per document: doc_id, n_words, log_prob (summed) and mean_log_prob, by a model trained on the same documents.

    With ``own_words`` the probabilities are those of the words themselves, else those of their ids.
    """
    import pyarrow as pa

    spark = docs.sparkSession
    ship_package(spark)
    blocks = blocks_of(ground(docs, doc_id=F.col(id_column), text=F.col(text_column)))
    counted, top = vocabulary(blocks)
    shared = spark.sparkContext.broadcast((top, train(blocks, top, rounds)))

    def likelihood(block, network, ids, own=None):
        """Rows of a block, by the ids of its words and what each adds."""
        sums = []
        for marked, lengths, codes in _parts(block, ids):
            sums.append(_sums(network.log_probs(marked, _places(marked, lengths)), lengths))
            if own is not None:
                sums[-1] += _sums(own[codes], lengths)
        return batches({
            "doc_id": (block["doc_ids"], None), "n_words": (pa.array(block["lengths"]), None),
            "log_prob": (pa.array(np.concatenate(sums)), None),
        })

    def score(stream):
        top, weights = shared.value
        network = Network(weights)
        for block in _blocks(stream, top):
            yield likelihood(block, network, block["ids"])

    def score_own(left, right):
        size = right.num_rows
        code, ids, own = right.column("code").to_numpy(), np.zeros(size, "int64"), np.zeros(size)
        ids[code], own[code] = right.column("id").to_numpy(), right.column("own").to_numpy()
        network = Network(shared.value[1])
        return pa.Table.from_batches([likelihood(block, network, ids, own) for block in _blocks(left.to_batches())])

    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    columns, parts = f"doc_id {kind}, n_words bigint, log_prob double", ["doc_ids", "lengths", "cuts", "codes"]
    if own_words:
        told = blocks.select(F.col("block").alias("of"), F.posexplode("words.word").alias("code", "word"))
        told = told.join(word_ids(counted, top), "word").select("of", "code", "id", "own")
        scored = blocks.select("block", *parts).groupBy("block").cogroup(told.groupBy("of")).applyInArrow(score_own, columns)
    else:
        scored = blocks.select(*parts, "shared", F.col("words.word").alias("words")).mapInArrow(score, columns)
    mean = F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words")).alias("mean_log_prob")
    done = materialize(scored.select("*", mean), "likelihood")
    discard(blocks, counted)
    return done
