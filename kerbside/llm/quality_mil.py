"""Operator 4: quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words.  Each passage is encoded (character classes, word shapes,
repetition, hashed words; then a learned hidden layer), a gated attention weighs the passages, and the weighted mean of their
representations gives the document's score.  Only documents carry labels; which passages matter is learned.

The model is trained in numpy on a bounded sample of labelled documents; every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import slices, text_bytes, words_at

PASSAGE_WORDS = 64
HASHED = 32
#: Bounds of the training sample: documents, and passages of one document (scoring has no bound).
TRAIN_DOCUMENTS = 4_000
TRAIN_PASSAGES = 256
_HIDDEN, _GATE, _STEPS, _RATE, _DECAY = 24, 12, 250, 0.02, 1e-4

_CLASS = np.zeros((256, 6), np.int32)  # lower, upper, digit, sentence mark, other ASCII mark, beyond ASCII
_CLASS[97:123, 0] = _CLASS[65:91, 1] = _CLASS[48:58, 2] = _CLASS[128:, 5] = 1
_CLASS[[33, 39, 44, 45, 46, 58, 59, 63], 3] = 1
_CLASS[33:127, 4] = 1 - _CLASS[33:127, :4].sum(axis=1)


def passages(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of a string column (float32 rows) and the offset of each text's passages; a text without words has one of zeros."""
    data, _ = text_bytes(column)
    hashes, offsets, begin, end = words_at(column)
    counts = np.diff(offsets)
    pieces = np.maximum(1, -(-counts // PASSAGE_WORDS))
    where = np.concatenate(([0], np.cumsum(pieces)))
    n = int(where[-1])
    x = np.zeros((n, 14 + HASHED), np.float32)
    if not len(hashes):
        return x, where
    owner = np.repeat(np.arange(len(counts)), counts)
    piece = where[owner] + (np.arange(len(hashes)) - offsets[owner]) // PASSAGE_WORDS
    size = np.bincount(piece, minlength=n)
    some = np.maximum(1, size)
    length = end - begin
    chars = np.maximum(1, np.bincount(piece, length, n))
    for c in range(6):
        total = np.concatenate(([0], np.cumsum(_CLASS[:, c][data], dtype=np.int64)))
        own = total[end] - total[begin]
        x[:, c] = np.bincount(piece, own, n) / chars
        if c == 1:
            x[:, 6] = np.bincount(piece, own == length, n) / some  # words all in capitals
        if c == 4:
            x[:, 7] = np.bincount(piece, own == length, n) / some  # words all of marks
            x[:, 8] = np.bincount(piece, own > 0, n) / some
    x[:, 9] = np.where(size > 0, chars / some / 10, 0)
    x[:, 10] = np.sqrt(np.maximum(0, np.bincount(piece, length.astype(float) ** 2, n) / some - (chars / some) ** 2)) / 10
    order = np.lexsort((hashes, piece))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (piece[order][1:] != piece[order][:-1])
    x[:, 11] = np.bincount(piece[order], fresh, n) / some
    again = np.zeros(len(hashes))
    again[1:] = (hashes[1:] == hashes[:-1]) & (piece[1:] == piece[:-1])
    x[:, 12] = np.bincount(piece, again, n) / some
    x[:, 13] = size / PASSAGE_WORDS
    cell = piece * HASHED + (hashes % np.uint64(HASHED)).astype(np.int64)
    x[:, 14:] = np.sqrt(np.bincount(cell, minlength=n * HASHED).reshape(n, HASHED) / some[:, None])
    return x, where


class AttentionModel:
    """Gated attention over a bag of passages; a few thousand numbers."""

    def __init__(self, dims: int, seed: int = 7):
        r = np.random.default_rng(seed)
        normal = lambda a, b: r.normal(0, 1 / np.sqrt(a), (a, b))
        self.w = {
            "e": normal(dims, _HIDDEN), "eb": np.zeros(_HIDDEN), "v": normal(_HIDDEN, _GATE), "u": normal(_HIDDEN, _GATE),
            "a": normal(_GATE, 1)[:, 0], "c": normal(_HIDDEN, 1)[:, 0], "cb": np.zeros(1),
        }
        self.mean, self.scale = np.zeros(dims), np.ones(dims)

    def _forward(self, x: np.ndarray, starts: np.ndarray) -> tuple:
        w = self.w
        h = np.tanh(x @ w["e"] + w["eb"])
        t, g = np.tanh(h @ w["v"]), 1 / (1 + np.exp(-(h @ w["u"])))
        s = np.clip((t * g) @ w["a"], -20, 20)
        e = np.exp(s)
        bag = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        weight = e / np.add.reduceat(e, starts[:-1])[bag]
        z = np.add.reduceat(weight[:, None] * h, starts[:-1])
        return h, t, g, bag, weight, z, 1 / (1 + np.exp(-(z @ w["c"] + w["cb"])))

    def score(self, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Chance of label 1 for each bag; every bag has a passage at least."""
        if len(starts) < 2:
            return np.zeros(0)
        return self._forward((x - self.mean) / self.scale, starts)[-1]

    def fit(self, x: np.ndarray, starts: np.ndarray, labels: np.ndarray) -> AttentionModel:
        self.mean, self.scale = x.mean(axis=0, dtype=np.float64), x.std(axis=0, dtype=np.float64) + 1e-3
        x = (x - self.mean) / self.scale
        w = self.w
        moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
        for step in range(1, _STEPS + 1):
            h, t, g, bag, weight, z, p = self._forward(x, starts)
            dz_ = (p - labels) / len(labels)
            dz = dz_[:, None] * w["c"]
            dh = weight[:, None] * dz[bag]
            along = (h * dz[bag]).sum(axis=1)
            ds = weight * (along - np.add.reduceat(weight * along, starts[:-1])[bag])
            dt, dg = ds[:, None] * w["a"] * g * (1 - t**2), ds[:, None] * w["a"] * t * g * (1 - g)
            dh += dt @ w["v"].T + dg @ w["u"].T
            de = dh * (1 - h**2)
            slope = {
                "e": x.T @ de, "eb": de.sum(axis=0), "v": h.T @ dt, "u": h.T @ dg, "a": (t * g).T @ ds, "c": z.T @ dz_, "cb": np.array([dz_.sum()])
            }
            for k, d in slope.items():
                d = d + _DECAY * w[k]
                m, s = moment[k]
                m += 0.1 * (d - m)
                s += 0.001 * (d * d - s)
                w[k] = w[k] - _RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
        return self


def _encode_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        x, where = passages(batch.column("text"))
        own = []
        for i in range(batch.num_rows):
            a, b = where[i], where[i + 1]
            every = np.linspace(a, b - 1, min(b - a, TRAIN_PASSAGES)).astype(np.int64)
            own.append(x[every].tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(own, pa.binary())], ["doc_id", "label", "x"])


def train(documents: DataFrame, labels: DataFrame, most: int = TRAIN_DOCUMENTS) -> AttentionModel:
    """Model from labelled documents: (doc_id, text) and (doc_id, label 0 or 1); about ``most`` of them, chosen by a hash of doc_id."""
    known = labels.filter("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    share = min(1.0, most / max(1, known.count()))
    chosen = known.filter(F.xxhash64("doc_id").cast("double") / 2.0**64 + 0.5 <= share).limit(2 * most)
    rows = documents.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text").mapInArrow(_encode_sample, "doc_id long, label int, x binary").limit(2 * most).collect()
    rows.sort(key=lambda r: (r.doc_id, bytes(r.x)))
    dims = 14 + HASHED
    model = AttentionModel(dims)
    bags = [np.frombuffer(bytes(r.x), np.float32).reshape(-1, dims) for r in rows]
    if not bags:
        return model
    starts = np.concatenate(([0], np.cumsum([len(b) for b in bags])))
    return model.fit(np.concatenate(bags), starts, np.array([r.label for r in rows], float))


def score_quality(documents: DataFrame, labels: DataFrame, learn_from: Column) -> DataFrame:
    """(doc_id, score) for each row of ``documents`` (doc_id, text): the chance, 0 to 1, that its label is 1.

    Labels (doc_id, label) are used only where ``learn_from`` holds of them.  Null and empty texts are one empty passage and get its score;
    a doc_id labelled twice counts as 1 if either label is; without labels the scores are those of an untrained model.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = documents.sparkSession.sparkContext.broadcast(train(docs, labels.filter(learn_from)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x, where = passages(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.value.score(x, where))], ["doc_id", "score"])

    return docs.mapInArrow(run, "doc_id long, score double")
