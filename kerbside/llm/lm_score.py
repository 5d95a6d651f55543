"""Operator 10: masked pseudo-likelihood scores of a bidirectional window network.

The network predicts a token from the two tokens on its left and the two on its right: one table of vectors for each of the
four places, summed and squashed, then a softmax over word classes and one over the words of the class.  A
document's score is the sum of the log-probabilities of all its tokens, each predicted with itself masked.

Tokens are words; the most frequent words of the whole corpus have a token of their own, the others share tokens by hash.  How many tokens there
are follows the number of distinct words (:func:`shape_of`).  A word that shares a token has the token's probability times its
own share of it, count / (counts of all words of the token + number of those words): the counts are of the whole corpus, and
the second term leaves room for words that were not counted.

Training is data-parallel over all positions of all texts.  Texts go to buckets by a hash of their id and text, about
``BUCKET_TOKENS`` tokens each, and lie in a fixed order inside, so a replica sees the same tokens in the same order however the table
is split.  In each round every bucket trains a replica, masking one in ``ROUNDS`` positions of every document (beginning at a place that
the text's hash and the round say, so that after all rounds every position has been masked once), and the replicas are averaged,
weighted by what they saw.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored
from .text import lists, slices, words

WIDTH = 24
ROUNDS = 2
PLACES = (-2, -1, 1, 2)
BUCKET_TOKENS = 4 << 20
_BATCH, _RATE = 4_096, 0.1
_CHUNK = 32_768
_BLOCKS = 16
_FAN = 64


@dataclass(frozen=True)
class Shape:
    """Number of word classes, of words in each, and of the tokens that words share."""

    classes: int = 32
    members: int = 64
    shared: int = 128

    @property
    def size(self) -> int:
        return self.classes * self.members

    @property
    def pad(self) -> int:
        return self.size


def shape_of(distinct: int) -> Shape:
    """2,048 tokens up to a million distinct words, then growing with the root of their number, to 32,768 tokens at 256 million.

    A replica has 120 numbers a token, so the root keeps it small beside what it is trained on.
    """
    doublings = min(4, max(0, math.ceil(math.log2(max(1, distinct) / (1 << 20)) / 2)))
    return Shape(32 << (doublings // 2), 64 << (doublings - doublings // 2), 128 << doublings)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, most=16 << 20):
        value, count = np.unique(words(batch.column("text"))[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(count.astype(np.int64))], ["word", "count"])


class Vocabulary:
    """Token of a word hash: classes hold words of like frequency; the first ``shape.shared`` tokens are for all other words."""

    def __init__(self, frequent: list[tuple[int, int]], total: int, shape: Shape):
        self.shape, shared = shape, shape.shared
        self.words = np.sort(np.array([w for w, _ in frequent], np.int64).view(np.uint64))
        by_count = np.array([w for w, _ in sorted(frequent, key=lambda x: (-x[1], x[0]))], np.int64).view(np.uint64)
        self.token = np.zeros(len(self.words), np.int32)
        self.token[np.searchsorted(self.words, by_count)] = np.arange(len(by_count)) + shared
        share = np.full(shape.size, 1.0)
        share[shared : shared + len(frequent)] += sorted((c for _, c in frequent), reverse=True)
        share[:shared] += max(0, total - sum(c for _, c in frequent)) / shared
        self.share = share / share.sum()
        self.room = np.ones(shared)  # counts of the words of each shared token, and one more a word

    def tokens(self, hashes: np.ndarray) -> np.ndarray:
        out = (hashes % np.uint64(self.shape.shared)).astype(np.int32)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
            known = self.words[at] == hashes
            out[known] = self.token[at[known]]
        return out


class WindowNetwork:
    """The network's numbers in one float32 array, with a view for each part."""

    def __init__(self, shape: Shape, flat: np.ndarray | None = None, share: np.ndarray | None = None):
        self.shape, classes, members = shape, shape.classes, shape.members
        parts = {
            "place": (len(PLACES), shape.size + 1, WIDTH), "bias": (WIDTH,), "class": (WIDTH, classes), "class_bias": (classes,),
            "member": (classes, WIDTH, members), "member_bias": (classes, members),
        }
        total = sum(int(np.prod(s)) for s in parts.values())
        if flat is None:
            flat = np.random.default_rng(11).normal(0, 0.1, total).astype(np.float32)
        self.flat, at = flat, 0
        self.part: dict[str, np.ndarray] = {}
        for name, dims in parts.items():
            n = int(np.prod(dims))
            self.part[name] = flat[at : at + n].reshape(dims)
            at += n
        if share is not None:
            by_class = share.reshape(classes, members)
            self.part["class_bias"][:] = np.log(by_class.sum(axis=1))
            self.part["member_bias"][:] = np.log(by_class / by_class.sum(axis=1, keepdims=True))
            self.part["bias"][:] = 0

    def _hidden(self, padded: np.ndarray, at: np.ndarray) -> np.ndarray:
        h = self.part["place"][0].take(padded[at + PLACES[0]], axis=0)
        h += self.part["bias"]
        for k in range(1, len(PLACES)):
            h += self.part["place"][k].take(padded[at + PLACES[k]], axis=0)
        return np.tanh(h, out=h)

    def _by_class(self, padded: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The order of the places ``at`` by the class of their tokens, where each class ends in it, and class and member of each token in that order."""
        token = padded[at]
        cls = (token // self.shape.members).astype(np.int16)
        order = np.argsort(cls, kind="stable")
        return order, np.searchsorted(cls[order], np.arange(self.shape.classes + 1)), cls[order], (token % self.shape.members)[order]

    @staticmethod
    def _logits(h: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
        """A column for each place, less its greatest number."""
        x = weights.T @ h.T
        x += bias[:, None]
        x -= x.max(axis=0)
        return x

    @classmethod
    def _log_probability(cls, h: np.ndarray, weights: np.ndarray, bias: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        x = cls._logits(h, weights, bias)
        own = x[chosen, np.arange(len(h))].astype(np.float64)
        return own - np.log(np.exp(x, out=x).sum(axis=0))

    @classmethod
    def _errors(cls, h: np.ndarray, weights: np.ndarray, bias: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """Probabilities less one for what was chosen, a column for each place."""
        x = cls._logits(h, weights, bias)
        np.exp(x, out=x)
        x /= x.sum(axis=0)
        x[chosen, np.arange(len(h))] -= 1
        return x

    def log_probabilities(self, padded: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log-probability of the tokens at the places ``at`` given their neighbours."""
        out = np.empty(len(at), np.float64)
        for lo in range(0, len(at), _CHUNK):
            order, ends, cls, member = self._by_class(padded, at[lo : lo + _CHUNK])
            h = self._hidden(padded, at[lo : lo + _CHUNK][order])
            got = self._log_probability(h, self.part["class"], self.part["class_bias"], cls)
            for c in range(self.shape.classes):
                own = slice(ends[c], ends[c + 1])
                if ends[c] < ends[c + 1]:
                    got[own] += self._log_probability(h[own], self.part["member"][c], self.part["member_bias"][c], member[own])
            out[lo + order] = got
        return out

    def train(self, padded: np.ndarray, at: np.ndarray, seen: WindowNetwork) -> None:
        """One pass over the places ``at`` in batches; ``seen`` keeps the sums of squared slopes."""
        members, biases = np.empty_like(self.part["member"]), np.empty_like(self.part["member_bias"])
        for lo in range(0, len(at), _BATCH):
            order, ends, cls, member = self._by_class(padded, at[lo : lo + _BATCH])
            own = at[lo : lo + _BATCH][order]
            n = len(own)
            h = self._hidden(padded, own)
            d = self._errors(h, self.part["class"], self.part["class_bias"], cls)
            dh = d.T @ self.part["class"].T
            for c in range(self.shape.classes):
                some = slice(ends[c], ends[c + 1])
                if ends[c] < ends[c + 1]:
                    e = self._errors(h[some], self.part["member"][c], self.part["member_bias"][c], member[some])
                    dh[some] += e.T @ self.part["member"][c].T
                    np.matmul(h[some].T, e.T, out=members[c])
                    e.sum(axis=1, out=biases[c])
                else:
                    members[c], biases[c] = 0, 0
            dh *= 1 - h * h
            self._move(seen, "member", members / n)
            self._move(seen, "member_bias", biases / n)
            self._move(seen, "class", h.T @ d.T / n)
            self._move(seen, "class_bias", d.sum(axis=1) / n)
            self._move(seen, "bias", dh.sum(axis=0) / n)
            for k, shift in enumerate(PLACES):
                near = padded[own + shift].astype(np.uint16)
                by = np.argsort(near, kind="stable")
                near = near[by]
                first = np.flatnonzero(np.diff(near, prepend=near[0] + np.uint16(1)))
                self._move_rows(seen.part["place"][k], k, near[first], np.add.reduceat(dh.take(by, axis=0), first, axis=0) / n)

    def _move(self, seen: WindowNetwork, name: str, slope: np.ndarray) -> None:
        squares = seen.part[name]
        squares += slope * slope
        slope *= _RATE
        slope /= np.sqrt(squares + 1e-10)
        self.part[name] -= slope

    def _move_rows(self, squares: np.ndarray, k: int, rows: np.ndarray, slope: np.ndarray) -> None:
        own = squares.take(rows, axis=0)
        own += slope * slope
        squares[rows] = own
        slope *= _RATE
        slope /= np.sqrt(own + 1e-10)
        self.part["place"][k][rows] -= slope


def _padded(hashes: np.ndarray, offsets: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all texts with two pads around each, and the place of each token there."""
    counts = np.diff(offsets)
    place = np.arange(len(hashes)) + 2 + 2 * np.repeat(np.arange(len(counts)), counts)
    padded = np.full(len(hashes) + 2 * len(counts) + 2, vocabulary.shape.pad, np.int32)
    padded[place] = vocabulary.tokens(hashes)
    return padded, place


def _tokens(shared):
    """Each text's tokens (16 bits each), and how many positions it begins to mask late."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in slices(batches):
            hashes, offsets = words(batch.column("text"))
            own = vocabulary.tokens(hashes).astype("<u2")
            rows = [own[lo:hi].tobytes() for lo, hi in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("bucket"), batch.column("mark"), pa.array(rows, pa.binary())], ["bucket", "mark", "tokens"])

    return run


def _one_bucket(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All texts of a bucket as one row, in the order of their marks, then of their tokens."""
    texts, bucket = [], 0
    for t in tables:
        bucket = t.column("bucket")[0].as_py()
        texts += zip(t.column("mark").to_pylist(), t.column("tokens").to_pylist(), strict=True)
    texts.sort()
    marks, tokens = [m for m, _ in texts], [x for _, x in texts]
    row = [pa.array([bucket], pa.int64()), pa.array([marks], pa.list_(pa.int64())), pa.array([[len(x) // 2 for x in tokens]], pa.list_(pa.int32()))]
    yield pa.RecordBatch.from_arrays([*row, pa.array([b"".join(tokens)], pa.binary())], ["bucket", "marks", "lengths", "tokens"])


def masked_places(padded_at: np.ndarray, offsets: np.ndarray, marks: np.ndarray, turn: int) -> np.ndarray:
    """The places a round masks: one in ``ROUNDS`` of every text, all of them after all rounds."""
    counts = np.diff(offsets)
    inside = np.arange(len(padded_at)) - np.repeat(offsets[:-1], counts)
    return padded_at[(inside + np.repeat(marks % ROUNDS, counts) + turn) % ROUNDS == 0]


def _replica(shared, turn: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape, flat = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                tokens = np.frombuffer(batch.column("tokens")[i].as_buffer(), "<u2").astype(np.int32)
                lengths = batch.column("lengths")[i].values.to_numpy()
                offsets = np.concatenate((np.zeros(1, np.int64), np.cumsum(lengths, dtype=np.int64)))
                place = np.arange(len(tokens)) + 2 + 2 * np.repeat(np.arange(len(lengths)), lengths)
                padded = np.full(len(tokens) + 2 * len(lengths) + 2, shape.pad, np.int32)
                padded[place] = tokens
                at = masked_places(place, offsets, batch.column("marks")[i].values.to_numpy(), turn)
                if not len(at):
                    continue
                own = WindowNetwork(shape, flat.astype(np.float32).copy())
                own.train(padded, at, WindowNetwork(shape, np.zeros_like(own.flat)))
                blocks = np.array_split(own.flat.astype(np.float16), _BLOCKS)
                key = [pa.array(range(_BLOCKS), pa.int32()), pa.array([batch.column("bucket")[i].as_py()] * _BLOCKS, pa.int64())]
                numbers = [pa.array([len(at)] * _BLOCKS, pa.int64()), pa.array([b.tobytes() for b in blocks], pa.binary())]
                yield pa.RecordBatch.from_arrays([*key, *numbers], ["block", "bucket", "trained", "numbers"])

    return run


def _added(kind):
    """Sum of one group's replicas of a block times what they saw, in the order of their buckets."""

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, block, part = [], 0, 0
        for t in tables:
            block = t.column("block")[0].as_py()
            rows += zip(t.column("bucket").to_pylist(), t.column("trained").to_pylist(), t.column("numbers").to_pylist(), strict=True)
        rows.sort(key=lambda r: r[0])
        part, total, weight = rows[0][0], 0.0, 0
        for _, n, value in rows:
            numbers = np.frombuffer(value, kind)
            total = total + (numbers.astype(np.float64) * n if kind == np.float16 else numbers)
            weight += n
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int32()), pa.array([part], pa.int64()), pa.array([weight], pa.int64()), pa.array([total.tobytes()], pa.binary())],
            ["block", "bucket", "trained", "numbers"],
        )

    return run


def train(documents: DataFrame) -> tuple[Vocabulary, np.ndarray, DataFrame]:
    """Vocabulary and network of all texts of ``documents``, and the counts (word, count) of the words without a token of their own.

    The driver gets the most frequent words, a row for each shared token and one averaged network a round.
    """
    texts = documents.select("text")
    counts = stored(texts.mapInArrow(_word_counts, "word long, count long").groupBy("word").agg(F.sum("count").alias("count")))
    distinct, total = counts.agg(F.count("*"), F.coalesce(F.sum("count"), F.lit(0))).first()
    shape = shape_of(distinct)
    frequent = counts.orderBy(F.desc("count"), "word").limit(shape.size - shape.shared).collect()
    vocabulary = Vocabulary([(r["word"], r["count"]) for r in frequent], total, shape)
    rare = counts
    if frequent:
        last = frequent[-1]
        rare = counts.filter((F.col("count") < last["count"]) | (F.col("count") == last["count"]) & (F.col("word") > last["word"]))
    for r in rare.groupBy(F.pmod("word", F.lit(shape.shared)).alias("token")).agg((F.sum("count") + F.count("*")).alias("room")).collect():
        vocabulary.room[r["token"]] = r["room"]
    flat = WindowNetwork(shape, share=vocabulary.share).flat
    if not total:
        return vocabulary, flat, rare

    context = documents.sparkSession.sparkContext
    n = max(1, round(total / BUCKET_TOKENS))
    marked = documents.filter("text IS NOT NULL").select(F.xxhash64("doc_id", "text").alias("mark"), "text")
    placed = marked.select(F.pmod("mark", F.lit(n)).alias("bucket"), F.shiftrightunsigned("mark", 1).alias("mark"), "text")
    rows = placed.mapInArrow(_tokens(context.broadcast(vocabulary)), "bucket long, mark long, tokens binary")
    buckets = stored(rows.groupBy("bucket").applyInArrow(_one_bucket, "bucket long, marks array<long>, lengths array<int>, tokens binary"))
    schema = "block int, bucket long, trained long, numbers binary"
    for turn in range(ROUNDS):
        replicas = buckets.mapInArrow(_replica(context.broadcast((shape, flat)), turn), schema)
        # in two steps, so that no task adds up more than some replicas: groups of buckets first, then the groups
        some = replicas.groupBy("block", F.floor(F.col("bucket") / _FAN)).applyInArrow(_added(np.float16), schema)
        done = some.groupBy("block").applyInArrow(_added(np.float64), schema).collect()
        if done:
            flat = np.concatenate([np.frombuffer(bytes(r.numbers), np.float64) / r.trained for r in sorted(done, key=lambda r: r.block)]).astype(np.float32)
    return vocabulary, flat, rare


def score_pseudo_likelihood(documents: DataFrame) -> DataFrame:
    """(doc_id, mean_log_likelihood, log_likelihood, n_tokens) for each row of ``documents`` (doc_id, text).

    ``log_likelihood`` is the sum of the conditional log-probabilities (natural logarithm) of all tokens.  Null and empty texts have no
    tokens, a sum of 0 and a null mean.  Repeated rows are scored alike.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    vocabulary, flat, rare = train(docs)
    shared = documents.sparkSession.sparkContext.broadcast((vocabulary, flat))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, flat = shared.value
        network = WindowNetwork(vocabulary.shape, flat.copy())
        for batch in slices(batches):
            hashes, offsets = words(batch.column("text"))
            padded, place = _padded(hashes, offsets, vocabulary)
            each = network.log_probabilities(padded, place)
            by_hash = np.flatnonzero(padded[place] < vocabulary.shape.shared)
            each[by_hash] -= np.log(vocabulary.room[padded[place[by_hash]]])
            total = np.concatenate(([0.0], np.cumsum(each)))
            counts, sums = np.diff(offsets), total[offsets[1:]] - total[offsets[:-1]]
            ends = np.searchsorted(by_hash, offsets)
            own = [np.unique(hashes[by_hash[a:b]], return_counts=True) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(counts.astype(np.int64)), pa.array(sums),
                    lists([w.view(np.int64) for w, _ in own], pa.int64()), lists([n.astype(np.int32) for _, n in own], pa.int32()),
                ],
                ["doc_id", "n_tokens", "sum", "words", "times"],
            )

    scored = docs.mapInArrow(run, "doc_id long, n_tokens long, sum double, words array<long>, times array<int>")
    scored = stored(scored.withColumn("row", F.monotonically_increasing_id()))
    # a word counted once adds log 1, so only the others are joined
    again = (
        scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("x")).select("row", F.col("x.words").alias("word"), F.col("x.times").alias("times"))
        .join(rare.filter("count > 1"), "word").groupBy("row").agg(F.sum(F.col("times") * F.log("count")).alias("more"))
    )
    whole = scored.select("row", "doc_id", "n_tokens", "sum").join(again, "row", "left")
    total = F.col("sum") + F.coalesce("more", F.lit(0.0))
    mean = F.when(F.col("n_tokens") > 0, total / F.col("n_tokens"))
    return whole.select("doc_id", mean.alias("mean_log_likelihood"), total.alias("log_likelihood"), "n_tokens")
