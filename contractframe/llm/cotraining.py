"""Quality by co-training: a classifier of what a text says and one of what its page is like.

The content view sees the text's byte trigrams, hashed to ``BUCKETS`` shares. The metadata view sees language,
source, length and the shape of the page (lines, words, kinds of characters, repetition). Both start from the
labelled documents. In each round each view labels all other documents, and the ``SHARE`` of them it is surest of
(in the proportion of the labels; equally sure ones go together) join the other view's training set. Each view is
then calibrated on labelled documents that no view was trained on, and the calibrated log-odds are averaged into
the score of every document.

Learning takes at most ``LABELLED`` labelled documents, those of smallest hash, whose features the driver holds.
Every document without a label takes part: its features are a Spark table, each round counts its log-odds by bins,
and the views are fitted by Newton steps from gradients and Hessians summed over all tasks. Which label a document
was handed follows from the models and limits of the rounds so far, so no table of labels is kept.

Defined results: null and empty texts have the features of an empty page; null languages and sources are
values of their own; a null id is never held out and has no label, nor do equal ids without one share a row; a document labelled more than once has its
smallest label; null labels are left out; without labels of both classes every score is 0; equal rows score
alike; an empty table gives no rows; other input columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contractframe.llm.common import batches, discard, ground, materialize, ship_package, slices
from contractframe.llm.toxicity import held_out
from contractframe.storage import shuffles_discarded

LABELLED, ROUNDS, SHARE = 6000, 6, 1 / 30
STEPS, CLOSE = 25, 0.05  # Newton steps a round at most; a step that ends them
FINE, MOST = 100, 30  # bins of log-odds: so many a unit, up to this either way
SURE = 2  # log-odds of at least this are handed on
BUCKETS, NAMES = 512, 32  # hashed trigrams; hashed languages and sources
_SHAPES = 14
_KINDS = np.zeros(256, "int64")  # lower, upper, digit, space, beyond ASCII, other
_KINDS[:] = 5
_KINDS[ord("a") : ord("z") + 1] = 0
_KINDS[ord("A") : ord("Z") + 1] = 1
_KINDS[ord("0") : ord("9") + 1] = 2
_KINDS[[9, 10, 11, 12, 13, 32]] = 3
_KINDS[128:] = 4


def content_features(text: str | None) -> np.ndarray:
    """Square roots of the shares of hashed byte trigrams."""
    raw = np.frombuffer((text or "").encode(), "uint8").astype("uint32")
    if len(raw) < 3:
        return np.zeros(BUCKETS)
    grams = (raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]) * np.uint32(2654435761)
    return np.sqrt(np.bincount(grams >> np.uint32(32 - BUCKETS.bit_length() + 1), minlength=BUCKETS) / len(grams))


def metadata_features(lang: str | None, source: str | None, text: str | None) -> np.ndarray:
    """Hashed names, and the shape of the page."""
    text = text or ""
    out = np.zeros(2 * NAMES + _SHAPES)
    out[zlib.crc32(f"l{lang}".encode()) % NAMES] = 1
    out[NAMES + zlib.crc32(f"s{source}".encode()) % NAMES] = 1
    raw = np.frombuffer(text.encode(), "uint8")
    counts = np.bincount(raw, minlength=256)
    kinds = np.bincount(_KINDS, counts, minlength=6) / max(1, len(raw))
    words, lines = text.split(), [x for x in text.split("\n") if x]
    shape = out[2 * NAMES :]
    shape[:6] = kinds
    shape[6] = np.log1p(len(raw))
    shape[7] = np.log1p(len(words))
    shape[8] = np.log1p(len(lines))
    shape[9] = len(set(words)) / max(1, len(words))
    shape[10] = len(set(lines)) / max(1, len(lines))
    shape[11] = len(raw) / max(1, len(words)) / 10
    shape[12] = np.count_nonzero(raw[1:] == raw[:-1]) / (len(raw) - 1) if len(raw) > 1 else 0
    shape[13] = np.count_nonzero(counts) / 256
    return out


@dataclass
class Logistic:
    """A linear classifier over standardised features."""

    weights: np.ndarray
    center: np.ndarray
    spread: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, scale: tuple[np.ndarray, np.ndarray] | None = None) -> Logistic:
        center, spread = scale or (x.mean(axis=0), x.std(axis=0) + 1e-3)
        model = cls(np.zeros(x.shape[1] + 1), center, spread)
        for _ in range(25):
            model, step = model.moved(*model.slopes(x, y))
            if step < 1e-6:
                break
        return model

    def slopes(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradient and Hessian of the loss over these rows."""
        design = np.column_stack([np.ones(len(x)), (x - self.center) / self.spread])
        p = 1 / (1 + np.exp(-np.clip(design @ self.weights, -30, 30)))
        half = design * np.sqrt(p * (1 - p) + 1e-6)[:, None]
        return design.T @ (p - y), half.T @ half

    def moved(self, gradient: np.ndarray, hessian: np.ndarray, penalty: float = 1.0) -> tuple[Logistic, float]:
        """The model after a Newton step, and the size of the step."""
        keep = penalty * np.eye(len(gradient))
        keep[0, 0] = 1e-6
        step = np.linalg.solve(hessian + keep, gradient + keep @ self.weights)
        return Logistic(self.weights - np.clip(step, -3, 3), self.center, self.spread), np.abs(step).max()

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.weights[0] + ((x - self.center) / self.spread) @ self.weights[1:], -30, 30)


@dataclass
class QualityModel:
    """The two views and their calibration; None without enough labels."""

    views: tuple[Logistic, Logistic] | None
    curves: tuple[Logistic, Logistic] | None

    def calibrated(self, content: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        """Calibrated log-odds of both views, as two rows."""
        return np.stack([c.log_odds(v.log_odds(x)[:, None]) for v, c, x in zip(self.views, self.curves, (content, metadata))])


Views = tuple[np.ndarray, np.ndarray]
_BINS = 2 * MOST * FINE


@dataclass
class Handed:
    """What a view handed on in a round: documents of at least bin ``high`` as good, up to bin ``low`` as bad."""

    teacher: Logistic
    low: int
    high: int


def _bins(odds: np.ndarray) -> np.ndarray:
    return np.clip(((odds + MOST) * FINE).astype("int64"), 0, _BINS - 1)


def _odds(models: list[Logistic], x: np.ndarray) -> np.ndarray:
    """The log-odds by each model, a row for each; the features are not standardised for every model anew."""
    weights = np.stack([m.weights[1:] / m.spread for m in models])
    starts = np.array([m.weights[0] for m in models]) - (np.stack([m.center for m in models]) * weights).sum(axis=1)
    return np.clip(x @ weights.T + starts, -30, 30).T


def _labels(history: list[Handed], x: np.ndarray) -> np.ndarray:
    """The label each document was handed first; NaN if none."""
    out = np.full(len(x), np.nan)
    for h, odds in zip(history, _odds([h.teacher for h in history], x) if history else ()):
        at, free = _bins(odds), np.isnan(out)
        out[free & (at >= h.high)] = 1
        out[free & (at <= h.low)] = 0
    return out


# Sums over documents, as vectors

def _moments(views: Views) -> np.ndarray:
    return np.concatenate([[len(views[0])], *[f(x).sum(axis=0) for x in views for f in (lambda x: x, np.square)]])


def _counts(history: tuple[list[Handed], list[Handed]], models: tuple[Logistic, Logistic], views: Views) -> np.ndarray:
    """Documents that each view has not handed on yet, by bins of its log-odds."""
    return np.concatenate([np.bincount(_bins(_odds([m], x)[0][np.isnan(_labels(h, x))]), minlength=_BINS) for h, m, x in zip(history, models, views)])


def _slopes(history: tuple[list[Handed], list[Handed]], models: tuple[Logistic, Logistic], views: Views) -> np.ndarray:
    """Gradient and upper half of the Hessian of each view over the documents that the other handed it."""
    out = []
    for pupil in (0, 1):
        y = _labels(history[1 - pupil], views[1 - pupil])
        given = ~np.isnan(y)
        gradient, hessian = models[pupil].slopes(views[pupil][given], y[given])
        out += [gradient, hessian[np.triu_indices(len(gradient))]]
    return np.concatenate(out)


class Here:
    """Documents in arrays."""

    def __init__(self, views: Views):
        self.views = views

    def sums(self, work: Callable[[Views], np.ndarray]) -> np.ndarray:
        return work(self.views)


class Stored:
    """Documents in a Spark table of features; only sums come to the driver."""

    def __init__(self, features: DataFrame):
        self.features = features

    def sums(self, work: Callable[[Views], np.ndarray]) -> np.ndarray:
        import pyarrow as pa

        context = self.features.sparkSession.sparkContext
        shared, width = context.broadcast(work), 64

        def add(stream):
            total = 0
            for batch in stream:
                if batch.num_rows:
                    total = total + shared.value(_views(batch.column("x").to_pylist()))
            if not np.isscalar(total):
                rows = np.pad(total.astype("float64"), (0, -len(total) % width)).reshape(-1, width)
                yield batches({"row": (pa.array(np.arange(len(rows))), None), **{f"c{i}": (pa.array(rows[:, i]), None) for i in range(width)}})

        # A vector for each task: a few tasks a core hold down what is sent.
        few = self.features.select("x").coalesce(2 * context.defaultParallelism)
        told = few.mapInArrow(add, "row bigint, " + ", ".join(f"c{i} double" for i in range(width)))
        with shuffles_discarded(self.features.sparkSession):  # there are many such sums
            got = told.groupBy("row").agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(width)]).toArrow().sort_by("row")
        none = work(_views([]))
        return np.column_stack([got.column(f"c{i}").to_numpy() for i in range(width)]).ravel()[: len(none)] if got.num_rows else none


def _views(rows: list[bytes]) -> Views:
    x = np.frombuffer(b"".join(rows), "float16").astype("float64").reshape(len(rows), BUCKETS + 2 * NAMES + _SHAPES)
    return x[:, :BUCKETS], x[:, BUCKETS:]


def _limits(counts: np.ndarray, most: float, rate: float) -> tuple[int, int]:
    """The bins down to which ``rate`` of ``most`` documents are good, and up to which the others are bad."""
    above, below = np.cumsum(counts[::-1])[::-1], np.cumsum(counts)
    good, bad = (np.flatnonzero(c >= np.ceil(n)) for c, n in ((above, most * rate), (below, most * (1 - rate))))
    return min(bad[0] if len(bad) else _BINS, (MOST - SURE) * FINE - 1), max(good[-1] if len(good) else 0, (MOST + SURE) * FINE)


def exchange(views: Views, y: np.ndarray, pool: Here | Stored, rounds: int = ROUNDS, share: float = SHARE) -> tuple[Logistic, Logistic]:
    """Both classifiers after handing each other the labels they are surest of, over all documents of the pool."""
    widths, y = [x.shape[1] for x in views], y.astype("float64")
    free = pool.sums(_moments)
    sums = free + _moments(views)
    ends = np.cumsum([1, *np.repeat(widths, 2)])
    scales = []
    for v in (0, 1):
        mean, square = (sums[ends[2 * v + k] : ends[2 * v + k + 1]] / sums[0] for k in (0, 1))
        scales.append((mean, np.sqrt(np.maximum(square - mean * mean, 0)) + 1e-3))
    models = tuple(Logistic.fit(x, y, s) for x, s in zip(views, scales))
    history: tuple[list[Handed], list[Handed]] = ([], [])
    for _ in range(rounds if free[0] else 0):
        counts = pool.sums(partial(_counts, history, models)).reshape(2, -1)
        for h, m, c in zip(history, models, counts):
            h.append(Handed(m, *_limits(c, free[0] * share, y.mean())))
        # From zero each time: undamped Newton steps from weights that are already sure overshoot.
        models = tuple(Logistic(np.zeros(n + 1), *scale) for n, scale in zip(widths, scales))
        for _ in range(STEPS):
            told, at, moved = pool.sums(partial(_slopes, history, models)), 0, []
            for x, m in zip(views, models):
                n = len(m.weights)
                half = np.zeros((n, n))
                half[np.triu_indices(n)] = told[at + n : at + n + n * (n + 1) // 2]
                gradient, hessian = m.slopes(x, y)
                moved.append(m.moved(gradient + told[at : at + n], hessian + half + np.triu(half, 1).T))
                at += n + n * (n + 1) // 2
            models = tuple(m for m, _ in moved)
            if max(step for _, step in moved) < CLOSE:
                break
    return models


def cotrain(views: Views, y: np.ndarray, pool: Views, rounds: int = ROUNDS, per_round: int | None = None) -> tuple[Logistic, Logistic]:
    """``exchange`` over arrays; ``per_round`` documents of the pool a round, else ``SHARE``."""
    return exchange(views, y, Here(pool), rounds, SHARE if per_round is None else per_round / max(1, len(pool[0])))


def _features(part) -> tuple[np.ndarray, np.ndarray]:
    texts = part.column("text").to_pylist()
    content = np.array([content_features(t) for t in texts]).reshape(-1, BUCKETS)
    metadata = np.array([metadata_features(*r) for r in zip(part.column("lang").to_pylist(), part.column("source").to_pylist(), texts)])
    return content, metadata.reshape(-1, 2 * NAMES + _SHAPES)


def _narrow(docs: DataFrame, id_column: str, text_column: str, lang_column: str, source_column: str) -> DataFrame:
    return ground(docs, doc_id=F.col(id_column).cast("bigint"), lang=F.col(lang_column).cast("string"), source=F.col(source_column).cast("string"), text=F.col(text_column))


def unlabelled(narrow: DataFrame, labelled: DataFrame) -> DataFrame:
    """Features of every document whose id has no label, stored in half precision."""
    import pyarrow as pa

    def look(stream):
        for batch in stream:
            for part in slices(batch, "text"):
                both = np.concatenate(_features(part), axis=1).astype("float16")
                yield batches({"doc_id": (part.column("doc_id"), None), "x": ([r.tobytes() for r in both], pa.binary())})

    every = narrow.mapInArrow(look, "doc_id bigint, x binary")
    # Features, not texts, are what a join too large for a broadcast deals out.
    return materialize(every.join(labelled.select("_id").distinct(), F.col("doc_id") == F.col("_id"), "left_anti").select("x"), "unlabelled")


def train(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
    source_column: str = "source", label_id: str = "doc_id", label: str = "quality",
) -> QualityModel:
    """Learn from labelled documents that are not held out and from all documents without a label."""
    import pyarrow as pa

    ship_package(docs.sparkSession)
    narrow = _narrow(docs, id_column, text_column, lang_column, source_column)
    labelled = labels.where(F.col(label_id).isNotNull()).select(F.col(label_id).cast("bigint").alias("_id"), F.col(label).cast("int").alias("y"))
    own = labelled.where(F.col("y").isin(0, 1) & ~held_out(F.col("_id"))).groupBy("_id").agg(F.min("y").alias("y"))
    near = lambda df, n: df.withColumn("_h", F.xxhash64("_id", F.lit(23))).orderBy("_h", "_id").limit(n)
    sample = near(own, LABELLED).select("_id", "y", (F.pmod("_h", F.lit(5)) == 0).alias("curve"))
    rows = narrow.join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))  # at most LABELLED rows of 13 bytes
    rows = rows.dropDuplicates(["doc_id"]).select("doc_id", "y", "curve", "lang", "source", "text")

    def look(stream):
        for batch in stream:
            for part in slices(batch, "text"):
                content, metadata = _features(part)
                both = np.concatenate([content, metadata], axis=1).astype("float32")
                yield batches({
                    "doc_id": (part.column("doc_id"), None), "y": (part.column("y"), None), "curve": (part.column("curve"), None),
                    "x": ([r.tobytes() for r in both], pa.binary()),
                })

    seen = rows.mapInArrow(look, "doc_id bigint, y int, curve boolean, x binary").toArrow().sort_by("doc_id")
    x = np.frombuffer(b"".join(seen.column("x").to_pylist()), "float32").astype("float64").reshape(seen.num_rows, BUCKETS + 2 * NAMES + _SHAPES)
    y = np.array(seen.column("y").to_pylist())
    curve = seen.column("curve").to_numpy().astype(bool)
    learn, check = ~curve, curve
    if len(set(y[learn])) < 2 or len(set(y[check])) < 2:
        return QualityModel(None, None)
    split = lambda rows: (x[rows][:, :BUCKETS], x[rows][:, BUCKETS:])
    features = unlabelled(narrow, labelled)
    views = exchange(split(learn), y[learn], Stored(features))
    discard(features)
    curves = tuple(Logistic.fit(v.log_odds(own)[:, None], y[check].astype("float64")) for v, own in zip(views, split(check)))
    return QualityModel(views, curves)


def score_documents(
    docs: DataFrame, model: QualityModel, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", source_column: str = "source",
) -> DataFrame:
    """Per document: doc_id, held_out, content_score, metadata_score, score and predicted (score of at least a half)."""
    import pyarrow as pa

    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(stream):
        own = shared.value
        for batch in stream:
            for part in slices(batch, "text"):
                odds = own.calibrated(*_features(part)) if own.views else np.full((2, part.num_rows), -np.inf)
                each = 1 / (1 + np.exp(-odds))
                whole = 1 / (1 + np.exp(-odds.mean(axis=0)))
                yield batches({
                    "doc_id": (part.column("doc_id"), None), "held_out": (part.column("held_out"), None), "content_score": (pa.array(each[0]), None),
                    "metadata_score": (pa.array(each[1]), None), "score": (pa.array(whole), None), "predicted": (pa.array((whole >= 0.5).astype("int32")), None),
                })

    narrow = _narrow(docs, id_column, text_column, lang_column, source_column)
    told = narrow.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang", "source", "text")
    return told.mapInArrow(score, "doc_id bigint, held_out boolean, content_score double, metadata_score double, score double, predicted int")
