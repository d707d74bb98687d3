"""Quality classifier: random-indexing word vectors, pooled per document, under a two-layer network.

A word is two terms: its lower-cased bytes, and its shape (kinds of its outer bytes, length, whether it repeats
the word before). Each term has a sparse random index vector, drawn from its hash. A term's word vector is the
sum of the index vectors of the words around it over the training texts, scaled to length one; terms share 2**15 hashed rows, so the
model's size is fixed. A document is the mean of its words' vectors. The network's probabilities are
calibrated by a temperature on rows that did not train it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogway.llm.common import MULTIPLIER, give_back, group_starts, mixed, narrowed, public_id, text_slices, tidy, word_bounds, word_hashes
from smogway.sources.staging import stage

#: The bound of the training sample: so many labelled rows, those with the smallest hash of doc_id.
TRAIN_ROWS = 20_000
THRESHOLD = 0.3
#: So many bytes of text at a time: the vectors of their words take a hundred times as much.
SLICE = 250_000
_ROWS = 1 << 15
_DIM = 32
_REACH = 2
_PLAIN = 4  # features beside the two pooled vectors
_HIDDEN = 32

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.arange(256, dtype=np.int64)  # punctuation stands for itself
_KIND[48:58], _KIND[65:91], _KIND[97:123], _KIND[128:] = 1, 2, 3, 3


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words, hashes of their shapes, whether each repeats the one before, and words per row."""
    starts, ends, count = word_bounds(data, offsets)
    words = word_hashes(_LOWER[data], starts, ends)
    row = np.repeat(np.arange(len(count)), count)
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
    kind, shape = _KIND[data], np.zeros(len(words), np.uint64)
    for at in (starts, np.minimum(starts + 1, ends - 1), np.maximum(ends - 3, starts), np.maximum(ends - 2, starts), ends - 1):
        shape = shape * np.uint64(257) + kind[at].astype(np.uint64)
    shape = shape * np.uint64(32) + np.minimum(ends - starts, 9).astype(np.uint64) * np.uint64(2) + again
    return words, mixed(shape * np.uint64(MULTIPLIER)), again, count


def _index_vectors(terms: np.ndarray) -> np.ndarray:
    """Four entries of +-1 among the dimensions, from the term's hash."""
    out = np.zeros((len(terms), _DIM), np.float32)
    at = np.arange(len(terms))
    for k in range(4):
        bits = (terms >> np.uint64(16 * k)).astype(np.int64)
        np.add.at(out, (at, bits & (_DIM - 1)), 1.0 - 2.0 * ((bits >> 8) & 1))
    return out


def _rows_of(terms: np.ndarray) -> np.ndarray:
    return (mixed(terms) >> np.uint64(49)).astype(np.int64)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the index vectors around each hashed term, one row per term that occurs in the task.

    The sums are whole numbers, exact as floats in any order.
    """
    total, seen = np.zeros((_ROWS, _DIM)), np.zeros(_ROWS, bool)
    for piece in text_slices(batches, limit=SLICE):
        words, shapes, _, count = _terms(piece.data, piece.offsets)
        if not len(words):
            continue
        own = _index_vectors(words) + _index_vectors(shapes)
        row = np.repeat(np.arange(len(count)), count)
        around = np.zeros_like(own)
        for step in range(1, _REACH + 1):
            near = (row[step:] == row[:-step])[:, None]
            around[step:] += own[:-step] * near
            around[:-step] += own[step:] * near
        for terms in (words, shapes):
            at = _rows_of(terms)
            order = np.argsort(at, kind="stable")
            begin = group_starts(at[order])
            some = at[order][begin]
            total[some] += np.add.reduceat(around[order], begin, axis=0, dtype=np.float64)
            seen[some] = True
    terms = np.flatnonzero(seen)
    for at in np.split(terms, range(4096, len(terms), 4096)):
        yield pa.RecordBatch.from_pydict({"part": at & 63, "at": at, "sum": [v.tobytes() for v in total[at]]})


def _added(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    at = table.column("at").to_numpy()
    values = np.frombuffer(b"".join(table.column("sum").to_pylist())).reshape(-1, _DIM)
    out = np.zeros((_ROWS, _DIM), np.float64)
    np.add.at(out, at, values)
    some = np.unique(at)
    return pa.table({"at": some, "sum": [v.tobytes() for v in out[some].astype(np.float32)]})


def _pooled(data: np.ndarray, offsets: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    words, shapes, again, count = _terms(data, offsets)
    out = np.zeros((len(count), 2 * _DIM + _PLAIN), np.float32)
    some = np.flatnonzero(count)
    if len(some):
        begin = (np.cumsum(count) - count)[some]
        for k, terms in enumerate((words, shapes)):
            sums = np.add.reduceat(vectors[_rows_of(terms)], begin, axis=0)
            out[some, k * _DIM : (k + 1) * _DIM] = sums / count[some, None]
        out[some, -4] = np.add.reduceat(again.astype(np.float32), begin) / count[some]
    size = np.diff(offsets)
    out[:, -3] = np.log1p(count)
    out[:, -2] = np.log1p(size / np.maximum(count, 1))
    out[:, -1] = count == 0
    return out


@dataclass
class Model:
    """Word vectors and network; `temperature` divides the logit."""

    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        logits = self.logits(_pooled(data, offsets, self.vectors).astype(np.float64))
        return 1 / (1 + np.exp(-np.clip(logits / self.temperature, -40, 40)))


def _trained(x: np.ndarray, y: np.ndarray, vectors: np.ndarray, epochs: int = 80, seed: int = 7) -> Model:
    """Adam on the log loss, with weight decay; the same rows give the same model."""
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(0), x.std(0) + 1e-3
    prior = (y.sum() + 1) / (len(y) + 2)
    m = Model(vectors, mean, scale, rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], _HIDDEN)), np.zeros(_HIDDEN),
              rng.normal(0, _HIDDEN**-0.5, _HIDDEN), float(np.log(prior / (1 - prior))))
    if y.min() == y.max():
        m.w2[:] = 0
        return m
    z, params = (x - mean) / scale, [m.w1, m.b1, m.w2, np.array([m.b2])]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for epoch in range(epochs):
        rate = 0.005 * (1 - epoch / epochs)
        order = rng.permutation(len(y))
        for at in range(0, len(y), 256):
            own = order[at : at + 256]
            hidden = np.tanh(z[own] @ params[0] + params[1])
            out = hidden @ params[2] + params[3][0]
            d = (1 / (1 + np.exp(-np.clip(out, -40, 40))) - y[own]) / len(own)
            back = np.outer(d, params[2]) * (1 - hidden**2)
            grads = [z[own].T @ back + 1e-4 * params[0], back.sum(0), hidden.T @ d + 1e-4 * params[2], np.array([d.sum()])]
            step += 1
            for p, g, a, b in zip(params, grads, first, second):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    m.b2 = float(params[3][0])
    return m


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss on a geometric grid, against smoothed labels, which keep it finite."""
    grid = np.geomspace(0.25, 16, 73)
    positive = y.sum()
    y = np.where(y > 0, (positive + 1) / (positive + 2), 1 / (len(y) - positive + 2))
    loss = [np.mean(np.logaddexp(0, logits / t) - y * logits / t) for t in grid]
    return float(grid[int(np.argmin(loss))])


def fold(doc_id: Column) -> Column:
    """crc32 of the doc_id as text, modulo 5; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Train on labelled rows outside fold 0: fold 1 calibrates, folds 2 to 4 train, at most `train_rows` in all.

    A document with several labels has its largest; NULL labels do not count. Without labels every score is 0.5.
    """
    known = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0))
        .groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("label_id"), "label_id").limit(train_rows)
    )
    known = stage(known, "labels")
    # at most train_rows rows of 12 bytes
    sample = stage(
        narrowed(docs).join(F.broadcast(known), F.col("doc_id") == F.col("label_id")).select("doc_id", "text", "quality"),
        "labelled",
    )
    vectors = np.zeros((_ROWS, _DIM), np.float32)
    sums = sample.mapInArrow(tidy(_contexts), "part long, at long, sum binary").groupBy("part").applyInArrow(_added, "at long, sum binary")
    for r in sums.toLocalIterator():  # at most 2**15 rows
        vectors[r["at"]] = np.frombuffer(r["sum"], np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True) + 1e-6
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_slices(batches, limit=SLICE):
            x = _pooled(piece.data, piece.offsets, shared.value)
            yield pa.RecordBatch.from_arrays(
                [piece.batch.column("doc_id"), piece.batch.column("quality"), pa.array([v.tobytes() for v in x])],
                ["doc_id", "quality", "x"],
            )

    rows = sample.mapInArrow(tidy(features), "doc_id long, quality int, x binary").withColumn("fold", fold(F.col("doc_id"))).collect()
    rows.sort(key=lambda r: (r.doc_id, r.x))
    if not rows:
        wide = 2 * _DIM + _PLAIN
        return Model(vectors, np.zeros(wide), np.ones(wide), np.zeros((wide, _HIDDEN)), np.zeros(_HIDDEN), np.zeros(_HIDDEN), 0.0)
    x = np.stack([np.frombuffer(r.x, np.float32) for r in rows]).astype(np.float64)
    y, folds = np.array([float(r.quality > 0) for r in rows]), np.array([r.fold for r in rows])
    train = folds != 1 if (folds != 1).any() else folds == 1
    model = _trained(x[train], y[train], vectors)
    if (folds == 1).sum() >= 20:
        model.temperature = _temperature(model.logits(x[folds == 1]), y[folds == 1])
    return model


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """`doc_id, held_out, score, predicted` for every row of `docs`, from its text alone; NULL texts are empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_slices(batches, limit=SLICE):
            scores = pa.array(shared.value.score(piece.data, piece.offsets))
            yield pa.RecordBatch.from_arrays([piece.batch.column("doc_id"), scores], ["doc_id", "score"])

    return narrowed(docs).mapInArrow(tidy(run), "doc_id long, score double").select(public_id(), "score").select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that score at least `threshold`; columns as given."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], ["text"])
        scores = pa.array(np.concatenate([np.zeros(0)] + [shared.value.score(p.data, p.offsets) for p in text_slices([batch], limit=SLICE)]))
        give_back()
        return scores

    return docs.where(scored(F.coalesce("text", F.lit(""))) >= threshold)
