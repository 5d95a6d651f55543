"""Words, word hashes and shingles of Arrow text columns, in numpy.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D of the UTF-8 text, with
A-Z lower-cased.  A task works through an Arrow batch in slices of about ``SLICE_BYTES``
of text, and through a longer text in pieces cut at white space, so what is held at once is
a small multiple of one slice plus eight bytes a word of the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
SHINGLE_WORDS = 5

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Gaps between runs of letters: every ASCII byte that is not a letter (other scripts' bytes count as letters).
NOT_LETTERS = np.arange(256) < 128
NOT_LETTERS[65:91] = NOT_LETTERS[97:123] = False


def mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64, over an array."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[_LOWER]
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_powers = np.cumprod(np.full(64, _BASE, dtype=np.uint64))


def _power(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.full(max(n, 2 * len(_powers)), _BASE, dtype=np.uint64))
    return _powers


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offset of every row's text in them; a null is empty."""
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, where, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(where, kind, n + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of whole rows with about ``most`` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(text))
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


def _pieces(data: np.ndarray, most: int, gaps: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about ``most`` bytes, cut at gaps."""
    start = 0
    while len(data) - start > 2 * most:
        gap = gaps[data[start + most : start + 2 * most]]
        stop, step = start + most, most
        while not gap.any():  # a word longer than a piece stays whole
            stop += step
            if stop >= len(data):
                break
            gap = gaps[data[stop : stop + step]]
        if stop >= len(data):
            break
        stop += int(gap.argmax()) + 1
        yield start, stop
        start = stop
    yield start, len(data)


def _piece_words(data: np.ndarray, starts: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and last byte (excluded) of every word; ``starts`` are byte offsets where a text begins."""
    keep = ~gaps[data]
    if not keep.any():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin = keep.copy()
    begin[1:] &= ~keep[:-1]
    inner = starts[starts < len(data)]
    begin[inner] = keep[inner]
    at = np.flatnonzero(keep)
    first = np.flatnonzero(begin[at])
    lengths = np.diff(np.append(first, len(at)))
    inside = np.arange(len(at)) - np.repeat(first, lengths)
    power = _power(int(lengths.max()))
    hashes = np.add.reduceat(_BYTE[data[at]] * power[inside], first)
    return mix(hashes + lengths.astype(np.uint64)), at[first], at[first] + lengths


def words(column: pa.Array, gaps: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of a string column, and the offset of each row's words in them."""
    hashes, offsets, _, _ = words_at(column, gaps)
    return hashes, offsets


def words_at(column: pa.Array, gaps: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As ``words``, with the first and last byte (excluded) of each word in ``text_bytes``."""
    data, offsets = text_bytes(column)
    hashes, first, last = [], [], []
    for start, stop in _pieces(data, SLICE_BYTES, gaps):
        inner = offsets[np.searchsorted(offsets, start) : np.searchsorted(offsets, stop)] - start
        h, a, b = _piece_words(data[start:stop], inner, gaps)
        hashes.append(h)
        first.append(a + start)
        last.append(b + start)
    begin = np.concatenate(first)
    return np.concatenate(hashes), np.searchsorted(begin, offsets), begin, np.concatenate(last)


def prefixes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first ``size`` bytes of the words longer than that, and which words those are."""
    longer = np.flatnonzero(end - begin > size)
    at, power = begin[longer], _power(size)
    total = np.zeros(len(at), np.uint64)
    for k in range(size):
        total += _BYTE[data[at + k]] * power[k]
    return mix(total + np.uint64(size << 32)), longer


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words of one word array, whichever texts they belong to."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power = _power(size)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += hashes[k : k + n] * power[k]
    return mix(total)


def row_shingles(hashes: np.ndarray, all_grams: np.ndarray, start: int, stop: int, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Shingle hashes of one row, in text order; with fewer words than ``size``, the whole sequence as one."""
    if stop - start >= size:
        return all_grams[start : stop - size + 1]
    if stop == start:
        return np.zeros(0, np.uint64)
    return mix(grams(hashes[start:stop], stop - start) + np.uint64(stop - start))


def lists(values: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """An Arrow list column of one array a row."""
    offsets = np.zeros(len(values) + 1, np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    flat = np.concatenate(values) if values else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))
