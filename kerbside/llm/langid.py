"""Operator 9: language identification by cross-parsing entropy.

A bounded sample of labelled text per language becomes a suffix automaton.  A text is cut greedily
into the longest phrases that occur in that sample (a cross-parsing); few phrases mean that the
sample predicts the text well.  ``phrases * log2(sample length) / text length`` estimates the
cross-entropy in bits a symbol, and the language with the least wins.

Parsing runs in tasks over all texts in full, many stretches of text at a time in numpy.
Symbols are lower-cased letters (the ``ALPHABET - RARE - 1`` most frequent of the samples, the others in
``RARE`` shared classes) and one symbol for any run of characters that are not letters.  Parsing starts anew
every ``STRETCH`` symbols.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import slices, text_bytes

ALPHABET = 64
RARE = 16
STRETCH = 1024
UNKNOWN = "und"
#: Bound of the training sample: characters a language, and of one document.
SAMPLE_CHARS = 32_768
SAMPLE_CHARS_PER_DOC = 2_000
_SAMPLE_DOCS = 96
_RESTART = np.int32(1 << 30)


def symbol_table(samples: dict[str, str]) -> np.ndarray:
    """Symbol of every code point; 0 for what is not a letter."""
    counts = Counter(c for text in samples.values() for c in text.lower() if c.isalpha())
    common = sorted(counts, key=lambda c: (-counts[c], c))[: ALPHABET - RARE - 1]
    own = {c: i + 1 for i, c in enumerate(common)}
    table = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            low = char.lower()
            low = low if len(low) == 1 else char
            table[point] = own.get(low) or ALPHABET - RARE + ord(low) % RARE
    return table


def symbols(points: np.ndarray, starts: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of texts laid end to end, each text's start in ``starts`` (with the end last); runs of 0 shrink to one."""
    raw = table[points]
    keep = np.ones(len(raw), bool)
    keep[1:] = (raw[1:] != 0) | (raw[:-1] != 0)
    inner = starts[:-1][starts[:-1] < len(raw)]
    keep[inner] = True
    return raw[keep], np.concatenate(([0], np.cumsum(keep)))[starts]


def suffix_automaton(sequence: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Transitions (state, symbol, target) of the automaton of all substrings of a symbol sequence; state 0 is the start."""
    following: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in sequence.tolist():
        state = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in following[p]:
            following[p][c] = state
            p = link[p]
        if p >= 0:
            q = following[p][c]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                clone = len(following)
                following.append(dict(following[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and following[p].get(c) == q:
                    following[p][c] = clone
                    p = link[p]
                link[q] = link[state] = clone
        last = state
    edges = [(s, c, t) for s, out in enumerate(following) for c, t in out.items()]
    a = np.array(edges, np.int32).reshape(-1, 3)
    return a[:, 0], a[:, 1].astype(np.uint8), a[:, 2]


def _dense(edges: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Next state by state * ALPHABET + symbol, plus ``_RESTART`` where a phrase begins.

    The last state is that before a phrase: where a text begins and after a symbol that the sample does not have.
    """
    outside = int(edges[2].max(initial=0)) + 1
    table = np.full((outside + 1, ALPHABET), -1, np.int32)
    table[edges[0], edges[1]] = edges[2]
    begin = np.where(table[0] < 0, outside, table[0]) + _RESTART
    return np.where(table < 0, begin[None, :], table).ravel()


def phrases(text: np.ndarray, starts: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    """Number of phrases of each text (rows) for each language (columns)."""
    lengths = np.diff(starts)
    pieces = -(-lengths // STRETCH)
    owner = np.repeat(np.arange(len(lengths)), pieces)
    total = np.zeros((len(lengths), len(tables)), np.int64)
    if not len(owner):
        return total
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = starts[:-1][owner] + nth * STRETCH
    size = np.minimum(STRETCH, starts[1:][owner] - begin)
    order = np.argsort(-size, kind="stable")
    begin, size, owner = begin[order], size[order], owner[order]
    most = int(size[0])
    active = np.searchsorted(-size, -np.arange(most), side="left")
    lanes = np.zeros((most, len(begin)), np.int32)
    for t in range(most):
        lanes[t, : active[t]] = text[begin[: active[t]] + t]
    for j, table in enumerate(tables):
        state = np.full(len(begin), len(table) // ALPHABET - 1, np.int32)
        number = np.zeros(len(begin), np.int32)
        for t in range(most):
            k = active[t]
            to = table[state[:k] * ALPHABET + lanes[t, :k]]
            number[:k] += to >> 30
            state[:k] = to & (_RESTART - 1)
        total[:, j] = np.bincount(owner, number, len(lengths)).astype(np.int64)
    return total


class LanguageModel:
    """Suffix automata of labelled samples; what tasks need of it is a few MB, bounded by ``SAMPLE_CHARS`` a language."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        self.table = symbol_table(samples)
        self.edges, self.bits = [], []
        for name in self.languages:
            points = np.array([ord(c) for c in samples[name]], np.int64)
            sequence, _ = symbols(points, np.array([0, len(points)]), self.table)
            self.edges.append(suffix_automaton(sequence))
            self.bits.append(math.log2(max(2, len(sequence))))
        self._dense: list[np.ndarray] | None = None

    def __getstate__(self):
        return self.__dict__ | {"_dense": None}

    def score(self, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and bits a symbol of each text."""
        if self._dense is None:
            self._dense = [_dense(e) for e in self.edges]
        data, offsets = text_bytes(column)
        points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        first_bytes = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        text, starts = symbols(points, first_bytes[offsets], self.table)
        letters = np.concatenate(([0], np.cumsum(text != 0)))[starts]
        known = np.diff(letters) > 0
        n = len(column)
        if not self.languages:
            return [UNKNOWN] * n, np.zeros(n), np.full(n, np.nan)
        rate = phrases(text, starts, self._dense) * np.array(self.bits) / np.maximum(1, np.diff(starts))[:, None]
        best = rate.argmin(axis=1)
        odds = np.exp(-4 * (rate - rate.min(axis=1, keepdims=True)))
        share = np.where(known, 1 / odds.sum(axis=1), 0.0)
        names = [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
        return names, share, np.where(known, rate.min(axis=1), np.nan)


def sample(labelled: DataFrame) -> dict[str, str]:
    """A bounded sample of text by language: (doc_id, text, lang) rows in order of a hash of doc_id and text."""
    rows = labelled.filter("text IS NOT NULL AND lang IS NOT NULL AND lang <> 'und' AND text RLIKE '[^\\\\x00-\\\\x40]'")
    counts = rows.groupBy("lang").count()  # a row a language
    place = F.xxhash64("doc_id", "text")
    share = F.lit(2.0 * _SAMPLE_DOCS) / F.col("count")
    near = rows.join(F.broadcast(counts), "lang").filter(place.cast("double") / 2.0**64 + 0.5 <= share)
    found = near.select("lang", place.alias("place"), F.substring("text", 1, SAMPLE_CHARS_PER_DOC).alias("text")).collect()
    texts: dict[str, str] = {}
    for row in sorted(found, key=lambda r: (r.lang, r.place, r.text)):
        texts[row.lang] = (texts.get(row.lang, "") + row.text + "\n")[:SAMPLE_CHARS]
    return texts


def _identify(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=2 << 20):
            names, share, rate = model.value.score(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in batch.schema.names if c != "text"], pa.array(names), pa.array(share), pa.array(rate)],
                [*[c for c in batch.schema.names if c != "text"], "lang_pred", "score", "bits"],
            )

    return run


def identify_languages(documents: DataFrame, learn_from: Column) -> DataFrame:
    """(doc_id, lang_pred, score, bits) for each row of ``documents`` (doc_id, text, lang; others are ignored).

    Automata learn from the rows where ``learn_from`` holds and text and lang are not null, at most
    ``SAMPLE_CHARS`` characters a language.  ``lang_pred`` is ``und`` with score 0 where the text is null or
    has no letter, or where there is nothing to learn from.  ``bits`` is the cross-entropy a symbol.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = LanguageModel(sample(docs.filter(learn_from)))
    shared = documents.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text").mapInArrow(_identify(shared), "doc_id long, lang_pred string, score double, bits double")


def rows_in_known_language(documents: DataFrame, learn_from: Column, least_score: float) -> DataFrame:
    """``documents`` without the rows that are ``und`` or whose score is under ``least_score``; columns as they were.

    Rows pass through the task that scores them, so nothing is shuffled.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    shared = documents.sparkSession.sparkContext.broadcast(LanguageModel(sample(docs.filter(learn_from))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=2 << 20):
            names, share, _ = shared.value.score(batch.column("text"))
            good = pa.array([n != UNKNOWN for n in names]).to_numpy(zero_copy_only=False) & (share >= least_score)
            yield batch.filter(pa.array(good))

    return documents.mapInArrow(run, documents.schema)
