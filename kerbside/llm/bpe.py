"""Operator 13: byte-level BPE encoding and decoding.

A text is cut at the special tokens of the vocabulary, the rest by the fixed pattern below into words, and every word's bytes
become a doubly linked list of symbols.  A priority queue holds the merges that neighbours allow, by rank, then by place; a popped
entry whose symbols have been merged away meanwhile is stale and skipped.  Decoding concatenates the bytes of the vocabulary strings.

Equal words have equal ids, so each Python worker keeps the ids of the words it met (about the last ``REMEMBERED``, none longer than
``LONGEST_REMEMBERED`` characters).  Only the vocabulary is broadcast; its size does not depend on the documents.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Fixed value: the pattern that cuts text into words before the merges.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECE = 1 << 20
REMEMBERED = 1 << 18
LONGEST_REMEMBERED = 64


def byte_letters() -> list[str]:
    """The character that stands for each byte in the vocabulary: visible Latin-1 characters for themselves, all others from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in visible else next(others)) for b in range(256)]


class Vocabulary:
    """Strings, merges and special tokens of a tokenizer file (JSON, byte-level BPE without normaliser)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = file.read()
        spec = json.loads(content)
        model, cut = spec["model"], spec["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and not model.get("ignore_merges") and not model.get("dropout") and spec["normalizer"] is None
        if not plain or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} has special tokens that take in their surroundings")
        self.key = hashlib.sha256(content.encode()).hexdigest()
        byte = {letter: b for b, letter in enumerate(byte_letters())}
        vocab = model["vocab"]
        self.specials: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings: dict[int, bytes] = {i: bytes(byte[c] for c in s) for s, i in vocab.items()}
        self.strings |= {i: s.encode() for s, i in self.specials.items()}
        self.bytes = [vocab[letter] for letter in byte_letters()]
        #: Rank of each pair of neighbours, and the symbol each rank makes.
        self.ranks: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocab[left], vocab[right]] = rank
            self.made.append(vocab[left + right])
        if len({*self.made}) < len(self.made):
            raise ValueError(f"{path} makes a symbol by two merges")


def merge_word(word: bytes, vocabulary: Vocabulary) -> tuple[int, ...]:
    """Ids of one word: merges by rank from a queue, over a linked list of symbols.

    A queue entry is rank * (length of the word) + place of the left symbol; ``ranks`` has the rank of each symbol's pair with the
    next one as it is now, and an entry with another rank is stale.  A symbol that went into its left neighbour is -1.
    """
    rank_of, made = vocabulary.ranks.get, vocabulary.made
    ids = [vocabulary.bytes[b] for b in word]
    n = len(ids)
    ranks = [*map(rank_of, zip(ids, ids[1:])), None]  # noqa: B905
    queue = [rank * n + at for at, rank in enumerate(ranks) if rank is not None]
    if not queue:
        return tuple(ids)
    heapify(queue)
    after, before = list(range(1, n + 1)), list(range(-1, n))
    while queue:
        rank, at = divmod(heappop(queue), n)
        if ranks[at] != rank:
            continue
        right = after[at]
        ids[at] = merged = made[rank]
        ids[right], ranks[right] = -1, None
        after[at] = following = after[right]
        before[following] = at
        if following < n:
            ranks[at] = rank = rank_of((merged, ids[following]))
            if rank is not None:
                heappush(queue, rank * n + at)
        else:
            ranks[at] = None
        left = before[at]
        if left >= 0:
            ranks[left] = rank = rank_of((ids[left], merged))
            if rank is not None:
                heappush(queue, rank * n + left)
    return tuple([i for i in ids if i >= 0])


class Remembered(dict):
    """Ids by string, made when they are first asked for; long strings are not kept.

    There are two generations of half the size each: when the young one is full it becomes the old one, and what is asked for again moves on.
    """

    def __init__(self, make):
        self.make, self.old = make, {}

    def __missing__(self, key: str) -> tuple[int, ...]:
        ids = self.old.pop(key, None)
        if ids is None:
            ids = self.make(key)
            if len(key) > LONGEST_REMEMBERED:
                return ids
        if len(self) >= REMEMBERED // 2:
            self.old = dict(self)
            self.clear()
        self[key] = ids
        return ids


#: The fixed pattern in the classes of the standard library, which is faster, and the characters whose class differs there.
_PLAIN_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_OTHER = frozenset("\x1c\x1d\x1e\x1f").union(c for c in map(chr, range(0x110000)) if unicodedata.category(c) in ("No", "Nl"))


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self._words = regex.compile(WORDS)
        longest_first = sorted(vocabulary.specials, key=len, reverse=True)
        self._special = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None
        self._specials = vocabulary.specials
        self._ids_of = Remembered(lambda word: merge_word(word.encode(), vocabulary)).__getitem__

    def encode(self, text: str) -> array:
        ids = array("i")
        words = _PLAIN_WORDS if _OTHER.isdisjoint(text) else self._words
        for i, part in enumerate(self._special.split(text) if self._special else [text]):
            if i % 2:
                ids.append(self._specials[part])
                continue
            for piece in _pieces(part):
                ids.extend(chain.from_iterable(map(self._ids_of, words.findall(piece))))
        return ids


def _pieces(text: str) -> Iterator[str]:
    """A long text in parts cut where a space follows another character, which no word contains inside."""
    start = 0
    while len(text) - start > 2 * PIECE:
        cut = _CUT.search(text, start + PIECE)
        if cut is None:
            break
        yield text[start : cut.start() + 1]
        start = cut.start() + 1
    yield text[start:]


_CUT = re.compile(r"\S ")


#: The encoder of the vocabulary used last in this worker, so that tasks share the remembered words.
_last: dict[str, Encoder] = {}


def encoder(vocabulary: Vocabulary) -> Encoder:
    if vocabulary.key not in _last:
        _last.clear()
        _last[vocabulary.key] = Encoder(vocabulary)
    return _last[vocabulary.key]


def decode(ids: list[int], strings: dict[int, bytes]) -> str:
    """The text of ids; ids that no string has are left out, bytes that are no UTF-8 become U+FFFD."""
    try:
        found = b"".join(map(strings.__getitem__, ids))
    except KeyError:
        found = b"".join([strings.get(i, b"") for i in ids])
    return found.decode("utf-8", "replace")


def bpe_encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids array<int>) of every row of ``docs`` by the vocabulary file at ``tokenizer`` (read by the driver).

    Null and empty texts have no ids (an empty array).  Special tokens that occur in a text become their id.  Rows with null or
    repeated doc_id stay rows of their own; other columns are dropped; an empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(shared.value).encode
        for batch in batches:
            found = [encode(t) if t else array("i") for t in batch.column("text").to_pylist()]
            offsets = np.zeros(len(found) + 1, np.int32)
            np.cumsum([len(ids) for ids in found], out=offsets[1:])
            flat = np.concatenate([np.frombuffer(ids, np.int32) for ids in found]) if found else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["doc_id", "ids"])

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def bpe_decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids, decoded) of a frame with doc_id and ids; null ids decode to the empty text, null and unknown ids inside are left out."""
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings = shared.value.strings
        for batch in batches:
            column = batch.column("ids").fill_null([])
            flat = column.flatten().fill_null(-1).to_numpy()
            ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(column.value_lengths().to_numpy(), dtype=np.int64)))
            texts = [decode(flat[lo:hi].tolist(), strings) for lo, hi in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"])

    return encoded.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "CAST(ids AS ARRAY<INT>) AS ids").mapInArrow(run, "doc_id long, ids array<int>, decoded string")
