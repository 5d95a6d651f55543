"""Operator 11: phrase collocation mining by top-order marginalisation.

Every word of a piece leads one window: the word itself and the next words up to the longest phrase, padded at the piece's end.  Only these
longest windows are counted; the counts of all shorter phrases are sums over what follows them, and one Spark ROLLUP over the window's
columns gives them all, since a phrase of any length is the prefix of exactly one window for each place it stands at.

Most windows of a large table occur once and cannot matter: a phrase is wanted from ``min_count`` occurrences on, and then so are all
its words and all shorter phrases inside it.  So words and pairs are counted first, by hash, then the longer runs of words whose
two shorter runs are frequent, length by length; a window is padded where it stops being frequent.  The filters are bitmaps of the frequent
hashes; whatever shares a cell with one only keeps its window longer, so all counts that are used stay exact.  A bitmap is sized
from the number of frequent hashes and at most 16 MB; far beyond that it lets more windows through and the ROLLUP does the work without
its help.

Hot words: windows are counted inside each slice of a task, then by Spark's partial aggregates; the joins of phrases with the counts of their
parts leave hot keys to AQE, and the best phrases are ranked in salted parts first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bitmap import bitmap, holds
from .tables import stored
from .text import _LOWER, _pieces, mix, text_bytes, words

#: Fixed values of the contract: what ends a piece, and what parts words inside one.
BREAKS = np.zeros(256, bool)
BREAKS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, 0x09]] = True
_NO_GAPS = np.zeros(256, bool)

SLICE = 2 << 20
SALTS = 16
#: Bits of a word's or pair's hash that are shuffled, and of the bitmap's cell numbers.
KEY_BITS = 40
LEAST_BITS, MOST_BITS = 16, 27
_PRIME = np.uint64(0x9E3779B97F4A7C15)


class Slice:
    """Words of some consecutive bytes of an Arrow batch: exact ids into ``dictionary``, the row, and whether the next word is in the same piece."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, first_row: int):
        apart = BREAKS[data]
        kept = ~(apart | BLANKS[data])
        begin = kept.copy()
        begin[1:] &= ~kept[:-1]
        begin[starts] = kept[starts]
        at = np.flatnonzero(begin)
        self.row = np.searchsorted(starts, at, side="right") + first_row - 1
        piece = np.cumsum(apart, dtype=np.int32)[at] + self.row
        self.joined = np.append(piece[1:] == piece[:-1], False) if len(at) else np.zeros(0, bool)
        where = np.append(np.cumsum(kept, dtype=np.int32)[at] - 1, int(kept.sum())) if len(at) else np.zeros(1, np.int32)
        letters = _LOWER[data[kept]]
        column = pa.StringArray.from_buffers(len(at), pa.py_buffer(where.astype(np.int32)), pa.py_buffer(letters))
        coded = column.dictionary_encode()
        self.dictionary, self.ids = coded.dictionary, coded.indices.to_numpy()

    def keys(self, lang_hash: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For lengths 1 to ``most``: ``KEY_BITS`` bits of a hash of the language and the words from each word on, and whether they are in one piece."""
        own = words(self.dictionary, _NO_GAPS)[0] if len(self.dictionary) else np.zeros(0, np.uint64)
        h, lang = own[self.ids], lang_hash[self.row]
        n, total, whole = len(h), h.copy(), np.ones(len(h), bool)
        for length in range(1, most + 1):
            if length > 1:
                k = length - 1
                following, goes_on = np.zeros(n, np.uint64), np.zeros(n, bool)
                following[: max(0, n - k)] = h[k:]
                goes_on[: n - k + 1] = self.joined[k - 1 :]
                total, whole = mix(total * _PRIME + following), whole & goes_on
            yield (mix(total + lang + np.uint64(length)) >> np.uint64(64 - KEY_BITS)).view(np.int64), whole

    def frequent(self, lang_hash: np.ndarray, bitmaps: list[tuple[np.ndarray, int]]) -> list[np.ndarray]:
        """For each length that a bitmap is for: from which words on that many may be a frequent phrase."""
        out: list[np.ndarray] = []
        for (key, whole), (packed, bits) in zip(self.keys(lang_hash, len(bitmaps)), bitmaps, strict=True):
            out.append(whole & _both_shorter(out) & holds(packed, key, bits))
        return out


def _both_shorter(found: list[np.ndarray]) -> np.ndarray | bool:
    """Whether the run of words one shorter is frequent both from a word and from the next one on."""
    return found[-1] & np.append(found[-1][1:], False) if found else True


def word_slices(batch: pa.RecordBatch) -> Iterator[Slice]:
    """The texts of a batch in slices that end with a piece, so that no window crosses one."""
    data, offsets = text_bytes(batch.column("text"))
    for start, stop in _pieces(data, SLICE, BREAKS):
        first = int(np.searchsorted(offsets, start, side="right")) - 1
        last = int(np.searchsorted(offsets, stop, side="left"))
        starts = np.maximum(offsets[first:last], start) - start
        if stop > start:
            yield Slice(data[start:stop], starts, first)


def _languages(batch: pa.RecordBatch) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The batch's languages, coded, and a hash for each row."""
    coded = batch.column("lang").dictionary_encode()
    names = [int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in coded.dictionary.to_pylist()]
    return coded, np.array(names, np.uint64)[coded.indices.to_numpy()] if names else np.zeros(0, np.uint64)


def _key_counts(lengths: tuple[int, ...], shared):
    """Hashes of the runs of words of these lengths whose shorter runs are frequent by the bitmaps so far, with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps = shared.value
        for batch in batches:
            _, lang_hash = _languages(batch)
            for part in word_slices(batch):
                wanted = _both_shorter(part.frequent(lang_hash, bitmaps))
                keys = [key[whole & wanted] for length, (key, whole) in enumerate(part.keys(lang_hash, lengths[-1]), 1) if length in lengths]
                found, n = np.unique(np.concatenate(keys), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n.astype(np.int64))], ["key", "n"])

    return run


def _window_counts(size: int, shared):
    """Distinct windows of a slice with their counts: lang, w1 ... w<size> (null where padded), n."""
    names = [f"w{i + 1}" for i in range(size)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps = shared.value
        for batch in batches:
            coded, lang_hash = _languages(batch)
            lang_of_row = coded.indices.to_numpy()
            for part in word_slices(batch):
                count = len(part.ids)
                if not count:
                    continue
                width = len(part.dictionary) + 1
                # a number for each window: extended by one column at a time, renumbered densely so that it never overflows
                columns, code = [], lang_of_row[part.row].astype(np.int64)
                for i, reach in enumerate(part.frequent(lang_hash, bitmaps)):
                    column = np.full(count, -1, np.int64)
                    column[: max(0, count - i)] = part.ids[i:]
                    column[~reach] = -1
                    columns.append(column)
                    code = np.unique(code * width + column + 1, return_inverse=True)[1]
                _, first, n = np.unique(code, return_index=True, return_counts=True)
                out = [coded.dictionary.take(pa.array(lang_of_row[part.row[first]]))]
                for column in columns:
                    ids = column[first]
                    out.append(part.dictionary.take(pa.array(ids, pa.int64(), mask=ids < 0)))
                yield pa.RecordBatch.from_arrays([*out, pa.array(n.astype(np.int64))], ["lang", *names, "n"])

    return run


def window_counts(docs: DataFrame, size: int, min_count: int) -> DataFrame:
    """Counts of the longest windows (lang, w1 ... w<size>, n), padded at the end of a piece and where they stop occurring ``min_count`` times."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    context, bitmaps = docs.sparkSession.sparkContext, []
    for lengths in [(1, 2), *[(k,) for k in range(3, size + 1)]]:
        keys = texts.mapInArrow(_key_counts(lengths, context.broadcast(bitmaps)), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
        frequent = stored(keys.filter(F.col("n") >= min_count).select("key"))
        bits = min(MOST_BITS, max(LEAST_BITS, (16 * frequent.count()).bit_length()))
        bitmaps = bitmaps + [(bitmap(frequent, "key", bits), bits)] * len(lengths)
    shared = context.broadcast(bitmaps)
    names = [f"w{i + 1}" for i in range(size)]
    schema = "lang string, " + ", ".join(f"{n} string" for n in names) + ", n long"
    return texts.mapInArrow(_window_counts(size, shared), schema).groupBy("lang", *names).agg(F.sum("n").alias("n"))


def phrase_counts(windows: DataFrame, size: int, min_count: int) -> DataFrame:
    """(lang, w1 ... w<size>, words, f): every phrase with ``f >= min_count`` occurrences, and a row without words with the language's total.

    ``windows`` has every distinct window once, so a phrase of ``size`` words is a row of it; all shorter ones come from the ROLLUP.
    """
    names = [f"w{i + 1}" for i in range(size)]
    longest = windows.filter(F.col(names[-1]).isNotNull()).select("lang", *names, F.lit(size).alias("words"), F.col("n").alias("f"))
    rolled = windows.rollup("lang", *names[:-1]).agg(F.sum("n").alias("f"), F.grouping_id().alias("_level"))
    words_of = size - 1 - F.bit_count("_level")  # the columns rolled up are the low bits of the grouping id
    whole = F.lit(True)
    for i, name in enumerate(names[:-1]):
        whole = whole & (F.col(name).isNotNull() | (F.col("words") <= i))
    shorter = rolled.filter(F.col("_level") < (1 << (size - 1))).withColumn("words", words_of).filter(whole)
    shorter = shorter.select("lang", *names[:-1], F.lit(None).cast("string").alias(names[-1]), "words", "f")
    return longest.unionByName(shorter).filter((F.col("words") == 0) | (F.col("f") >= min_count))


def _with_count(phrases: DataFrame, counts: DataFrame, words_at: list[str], name: str) -> DataFrame:
    """The phrases with the count of the part that stands in the columns ``words_at``, one row of ``counts``.

    Many phrases may share a part; AQE splits such a key on their side (what follows is another join by another key).
    """
    part = counts.filter(F.col("words") == len(words_at)).select(
        F.col("lang").alias("_lang"), *[F.col(f"w{i + 1}").alias(f"_w{i}") for i in range(len(words_at))], F.col("f").alias(name)
    )
    on = [F.col("lang") == F.col("_lang")] + [F.col(w) == F.col(f"_w{i}") for i, w in enumerate(words_at)]
    return phrases.join(part, on).drop("_lang", *[f"_w{i}" for i in range(len(words_at))])


def scored_phrases(counts: DataFrame, size: int) -> DataFrame:
    """(lang, phrase, words, w1 ..., a, l, r, score): all candidates with their lowest-scoring cut, ties to the shortest first part."""
    found = None
    for length in range(2, size + 1):
        names = [f"w{i + 1}" for i in range(length)]
        rows = counts.filter(F.col("words") == length).withColumnRenamed("f", "a").withColumn("phrase", F.concat_ws(" ", *names))
        cuts = []
        for k in range(1, length):
            rows = _with_count(rows, counts, names[:k], f"_l{k}")
            rows = _with_count(rows, counts, names[k:], f"_r{k}")
            score = F.expr(f"CAST(1000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)) DIV (CAST(_l{k} AS DECIMAL(18,0)) * CAST(_r{k} AS DECIMAL(18,0)))")
            cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"_l{k}").alias("l"), F.col(f"_r{k}").alias("r")))
        best = F.least(*cuts) if len(cuts) > 1 else cuts[0]
        rows = rows.withColumn("_cut", best).select("lang", "phrase", "words", *[f"w{i + 1}" for i in range(size)], "a", "_cut.l", "_cut.r", "_cut.score")
        found = rows if found is None else found.unionByName(rows)
    return found


def not_inside_longer(phrases: DataFrame, counts: DataFrame, size: int, share: int = 50) -> DataFrame:
    """Without the phrases that stand inside a longer one that has at least ``share`` per cent of their occurrences."""
    for length in range(2, size):
        names = [f"w{i + 1}" for i in range(length)]
        inside = None
        for longer in range(length + 1, size + 1):
            rows = counts.filter(F.col("words") == longer)
            for shift in range(longer - length + 1):
                part = rows.select("lang", *[F.col(f"w{i + 1 + shift}").alias(f"w{i + 1}") for i in range(length)], "f")
                inside = part if inside is None else inside.unionByName(part)
        longest = inside.groupBy("lang", *names).agg(F.max("f").alias("_longer")).withColumn("words", F.lit(length))
        joined = phrases.join(longest, ["lang", *names, "words"], "left")
        phrases = joined.filter(F.col("_longer").isNull() | (100 * F.col("_longer") < share * F.col("a"))).drop("_longer")
    return phrases


def collocations(docs: DataFrame, size: int = 3, min_count: int = 10, best: int = 2000, share: int = 50) -> DataFrame:
    """The ``best`` phrases of 2 to ``size`` words of each language by cohesion: lang, rank, phrase, a, l, r, n, score.

    A-Z are lower-cased; pieces end at ``.,;:!?`` and line ends, words are parted by blanks and tabs.  ``a`` is the phrase's count, ``l`` and ``r``
    those of the two parts of its weakest cut, ``score`` is floor(10^6 * a * a / (l * r)), ``n`` the number of words of the language.
    A null language is ``und``, a null text is empty; repeated rows count each time; rows that tie in score and count are ranked by the
    phrase's bytes; an empty table, or one without a phrase that is frequent enough, gives an empty result.  Counts reach 10^15 exactly.
    """
    counts = stored(phrase_counts(stored(window_counts(docs, size, min_count)), size, min_count))
    phrases = not_inside_longer(scored_phrases(counts, size), counts, size, share)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    first = phrases.withColumn("_part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order)))
    ranked = first.filter(F.col("rank") <= best).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    total = counts.filter("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.filter(F.col("rank") <= best).join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
