"""Toxicity by class-conditional Kneser-Ney models of letters.

Two models, of toxic and of ordinary texts, give the likelihood of each letter of a word after the letters
before it. The highest order is counted for each class; every lower order is one shared set of Kneser-Ney
continuation counts, so an expression that neither class has seen says nothing, and a rare one says what its
parts say. As the shared part is the same for both, the log-likelihood ratio of a letter is a table entry
where a class has seen it, and else depends on its context alone.

A text is judged by length-normalised log-likelihood ratios: of the whole text per letter, of its most telling
words, and of all words that lean to toxic, by the number of words (see ``evidence``), so that a long text can't
hide a few expressions and no single odd word decides. A logistic curve fitted on labelled texts turns these into
a score; each of those texts is judged by models counted without its fold.

Learning takes at most ``SAMPLE_ROWS`` labelled documents (those of smallest hash). Everything the driver and the broadcast hold follows from them: their n-grams, as a table,
the ratios of one fold at a time, and their few features.

Defined results: null and empty texts and texts without letters score as texts without any evidence; a null
id is never held out and has no label; a document labelled more than once counts as toxic if any label says
so; null labels are left out; without labels of both classes every score is 0; equal rows score alike; an
empty table gives no rows; other input columns are ignored (``reject_toxic`` keeps them).
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractframe.llm.common import batches, discard, ground, materialize, ship_package, slices

ORDER, DISCOUNT = 5, 0.75
SAMPLE_ROWS, FOLDS = 20_000, 4
EVIDENCE = 9  # numbers that stand for a text
THRESHOLD = 0.7
_WORDS = re.compile(r"[^\W\d_]{1,64}")  # longer runs of letters are several words
_CACHE_WORDS = 200_000


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _words(text: str | None) -> list[str]:
    return _WORDS.findall(text.lower()) if text else []


def ngram_counts(words: Counter) -> Counter:
    """Counts of the highest order: each letter of a word with up to ORDER - 1 letters before it."""
    found: Counter = Counter()
    for word, n in words.items():
        s = f"^{word}$"
        for j in range(1, len(s)):
            found[s[max(0, j - ORDER + 1) : j + 1]] += n
    return found


class _Level:
    """Discounted counts of one order: of n-grams, and of their contexts."""

    def __init__(self, counts: dict[str, int]):
        self.counts, self.total, self.kinds = counts, Counter(), Counter()
        for gram, n in counts.items():
            self.total[gram[:-1]] += n
            self.kinds[gram[:-1]] += 1

    def kept(self, gram: str) -> float:
        return max(self.counts.get(gram, 0) - DISCOUNT, 0.0) / self.total[gram[:-1]]

    def weight(self, context: str) -> float:
        """What the discount leaves to the lower order."""
        return DISCOUNT * self.kinds[context] / self.total[context]


class LetterRatios:
    """log P(letter | context, toxic) - log P(letter | context, ordinary), precomputed."""

    def __init__(self, toxic: dict[str, int], ordinary: dict[str, int]):
        classes = (_Level(toxic), _Level(ordinary))
        grams = set(toxic) | set(ordinary)
        letters = len({g[-1] for g in grams}) + 1
        shared, below = [], grams
        while any(len(g) > 1 for g in below):
            # Continuation counts: the kinds of n-grams one longer that end in this one.
            shared.append(_Level(Counter(g[1:] for g in below if len(g) > 1)))
            below = set(shared[-1].counts)
        known: dict[str, float] = {}

        def lower(gram: str) -> float:
            """Shared probability of the last letter after the others."""
            if gram not in known:
                level = next((s for s in shared if gram[:-1] in s.total), None)
                rest = lower(gram[1:]) if len(gram) > 1 else 1 / letters
                known[gram] = rest if level is None else level.kept(gram) + level.weight(gram[:-1]) * rest
            return known[gram]

        def log(level: _Level, gram: str) -> float:
            rest = lower(gram[1:]) if len(gram) > 1 else 1 / letters
            return math.log(rest if gram[:-1] not in level.total else level.kept(gram) + level.weight(gram[:-1]) * rest)

        self.seen = {g: log(classes[0], g) - log(classes[1], g) for g in grams}
        self.unseen = {
            h: sum(sign * math.log(c.weight(h)) for sign, c in zip((1, -1), classes) if h in c.total)
            for h in {g[:-1] for g in grams}
        }
        # The functions above refer to themselves; what they hold is large and goes now, not with the next collection.
        shared.clear()
        known.clear()

    def word(self, word: str) -> float:
        """Log-likelihood ratio of a word."""
        s, seen, unseen, total = f"^{word}$", self.seen, self.unseen, 0.0
        for j in range(1, len(s)):
            gram = s[max(0, j - ORDER + 1) : j + 1]
            ratio = seen.get(gram)
            total += unseen.get(gram[:-1], 0.0) if ratio is None else ratio
        return total


class _WordRatios(dict):
    def __init__(self, ratios: LetterRatios):
        super().__init__()
        self.ratios = ratios

    def __missing__(self, word):
        if len(self) >= _CACHE_WORDS:
            self.clear()
        value = self[word] = self.ratios.word(word)
        return value


def evidence(words: dict[str, float], text: str | None) -> list[float]:
    """The ratio of the whole text per letter; of its first, second, third and fifth most telling word; the ratios
    beyond 2 of all words by the root of their number; how many lean clearly, and a little, to toxic; its words."""
    found = _words(text)
    if not found:
        return [0.0] * EVIDENCE
    ratio = np.fromiter(map(words.__getitem__, found), "float64", len(found))
    letters = sum(map(len, found)) + len(found)
    most = min(5, len(found))
    top = np.zeros(5)
    top[:most] = np.sort(np.partition(ratio, -most)[-most:])[::-1]
    strong = np.maximum(ratio - 2, 0).sum() / math.sqrt(len(found))
    return [
        ratio.sum() / letters, top[0], top[1], top[2], top[4], strong,
        math.log1p(np.count_nonzero(ratio > 3)), math.log1p(np.count_nonzero(ratio > 1.5)), math.log(len(found)),
    ]


@dataclass
class Curve:
    """A logistic curve over standardised evidence."""

    weights: np.ndarray
    center: np.ndarray
    spread: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + ((x - self.center) / self.spread) @ self.weights[1:], -30, 30)))


def _fit(x: np.ndarray, y: np.ndarray, penalty: float = 0.05) -> Curve:
    """Logistic regression by Newton's steps."""
    center, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    design = np.column_stack([np.ones(len(x)), (x - center) / spread])
    w = np.zeros(design.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        step = np.linalg.solve((design.T * (p * (1 - p) + 1e-9)) @ design + penalty * np.eye(len(w)), design.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return Curve(w, center, spread)


class ToxicityModel:
    """Scores of texts; made of the letter ratios and the curve."""

    def __init__(self, ratios: LetterRatios | None, curve: Curve | None):
        self.ratios, self.curve, self._cache = ratios, curve, None

    def scores(self, texts: Iterable[str | None]) -> np.ndarray:
        texts = list(texts)
        if self.curve is None or not texts:
            return np.zeros(len(texts))
        self._cache = self._cache if self._cache is not None else _WordRatios(self.ratios)
        return self.curve(np.array([evidence(self._cache, t) for t in texts]))


def _sums(counted) -> Iterator[tuple[str, int]]:
    """Each n-gram of a table of counts and the sum of its counts."""
    added = counted.group_by("gram", use_threads=False).aggregate([("c", "sum")])
    for part in added.to_batches(max_chunksize=10_000):
        yield from zip(part.column("gram").to_pylist(), part.column("c_sum").to_pylist())


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_id: str = "doc_id", label: str = "toxic") -> ToxicityModel:
    """Learn from labelled documents that are not held out."""
    import pyarrow as pa
    import pyarrow.compute as pc

    ship_package(docs.sparkSession)
    told = labels.where(F.col(label).isNotNull() & F.col(label_id).isNotNull() & ~held_out(F.col(label_id)))
    own = told.groupBy(F.col(label_id).cast("bigint").alias("_id")).agg(F.max(F.col(label).cast("int")).alias("y"))
    sample = own.withColumn("_h", F.xxhash64("_id", F.lit(17))).orderBy("_h", "_id").limit(SAMPLE_ROWS)
    sample = sample.select("_id", "y", F.pmod("_h", F.lit(FOLDS)).cast("int").alias("fold"))
    rows = materialize(ground(docs, doc_id=F.col(id_column).cast("bigint"), text=F.col(text_column)).join(
        F.broadcast(sample), F.col("doc_id") == F.col("_id")  # at most SAMPLE_ROWS rows of 13 bytes
    ).where("y IN (0, 1)").select("y", "fold", "text"), "labelled-texts")

    def count(stream):
        for batch in stream:
            found: dict[tuple[int, int], Counter] = defaultdict(Counter)
            for y, fold, text in zip(*(batch.column(c).to_pylist() for c in ("y", "fold", "text"))):
                found[y, fold].update(_words(text))
            for (y, fold), words in found.items():
                grams = ngram_counts(words)
                n = len(grams)
                yield batches({
                    "gram": (list(grams), pa.string()), "y": ([y] * n, pa.int32()), "fold": ([fold] * n, pa.int32()), "c": (list(grams.values()), pa.int64()),
                })

    counted = rows.mapInArrow(count, "gram string, y int, fold int, c bigint").groupBy("gram", "y", "fold").agg(F.sum("c").alias("c")).toArrow()

    def without(left_out: int) -> LetterRatios | None:
        """Ratios of all folds but one; -1 leaves none out."""
        pa.default_memory_pool().release_unused()
        own = counted.filter(pc.not_equal(counted.column("fold"), left_out))
        toxic, ordinary = (dict(_sums(own.filter(pc.equal(own.column("y"), y)))) for y in (1, 0))
        return LetterRatios(toxic, ordinary) if toxic and ordinary else None

    names = [f"x{i}" for i in range(EVIDENCE)]

    def judged(fold: int):
        """The evidence of a fold's texts by ratios that do not know them."""
        ratios = without(fold)
        if ratios is None:
            return None
        shared = docs.sparkSession.sparkContext.broadcast(ratios)
        del ratios

        def look(stream):
            words = _WordRatios(shared.value)
            for batch in stream:
                x = np.array([evidence(words, t) for t in batch.column("text").to_pylist()]).reshape(-1, EVIDENCE)
                yield batches({"y": (batch.column("y"), None), **{c: (pa.array(x[:, i]), None) for i, c in enumerate(names)}})

        told = rows.where(F.col("fold") == fold).select("y", "text").mapInArrow(look, "y int, " + ", ".join(f"{c} double" for c in names)).toArrow()
        shared.destroy()
        return told

    ratios = without(-1)
    if ratios is None:
        discard(rows)
        return ToxicityModel(None, None)
    judgements = [told for told in map(judged, range(FOLDS)) if told is not None]
    discard(rows)
    if not judgements:
        return ToxicityModel(None, None)
    seen = pa.concat_tables(judgements)
    pa.default_memory_pool().release_unused()
    y = seen.column("y").to_numpy()
    if len(set(y.tolist())) < 2:
        return ToxicityModel(None, None)
    # Rows come in no fixed order; sorting fixes the sums of the fit.
    x = np.column_stack([seen.column(c).to_numpy() for c in names])
    order = np.lexsort([*x.T, y])
    return ToxicityModel(ratios, _fit(x[order], y[order].astype("float64")))


def score_documents(docs: DataFrame, model: ToxicityModel, id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    import pyarrow as pa

    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.ratios, model.curve))

    def score(stream):
        own = ToxicityModel(*shared.value)
        for batch in stream:
            for part in slices(batch, "text"):
                scores = own.scores(part.column("text").to_pylist())
                yield batches({
                    "doc_id": (part.column("doc_id"), None), "held_out": (part.column("held_out"), None),
                    "score": (pa.array(scores), None), "predicted": (pa.array((scores >= threshold).astype("int32")), None),
                })

    narrow = ground(docs, doc_id=F.col(id_column), held_out=held_out(F.col(id_column)), text=F.col(text_column))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int")


def reject_toxic(docs: DataFrame, model: ToxicityModel, text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns, that are not predicted toxic."""
    import pyarrow as pa

    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.ratios, model.curve))

    def keep(stream):
        own = ToxicityModel(*shared.value)
        for batch in stream:
            for part in slices(batch, text_column):
                yield part.filter(pa.array(own.scores(part.column(text_column).to_pylist()) < threshold))

    return docs.mapInArrow(keep, docs.schema)
