"""A bitmap of fixed size over hashes of a column: small enough for every task, whatever the table.

Cells are shared, so membership can be wrong in one direction only; a filter by it drops nothing that is in the column.
Beyond some hundred million distinct values it lets nearly all through, and what follows it does all the work.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .text import mix

_BLOCKS = 64
_ROWS = 512


def cells(values: np.ndarray, bits: int) -> np.ndarray:
    return (mix(values.view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def _rows(column: str, bits: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(1 << bits, bool)
        for batch in batches:
            values = batch.column(column)
            flat = values.flatten() if pa.types.is_list(values.type) else values
            found[cells(flat.drop_null().to_numpy(), bits)] = True
        blocks = np.packbits(found).reshape(_BLOCKS, -1)
        used = np.flatnonzero(blocks.any(axis=1))
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array([blocks[i].tobytes() for i in used], pa.binary())], ["block", "bits"])

    return run


def _or(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, block = None, 0
    for t in tables:
        block = t.column("block")[0].as_py()
        for value in t.column("bits"):
            own = np.frombuffer(value.as_buffer(), np.uint8)
            total = own if total is None else total | own
    yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["block", "bits"])


def bitmap(table: DataFrame, column: str, bits: int) -> np.ndarray:
    """Which of 2^bits cells the values of a long or array<long> column fall in, packed (2^bits / 8 bytes on the driver)."""
    rows = table.select(column).mapInArrow(_rows(column, bits), "block int, bits binary").groupBy("block").applyInArrow(_or, "block int, bits binary")
    blocks = np.zeros((_BLOCKS, (1 << bits) // 8 // _BLOCKS), np.uint8)
    for row in rows.collect():  # at most a row a block
        blocks[row.block] = np.frombuffer(bytes(row.bits), np.uint8)
    return blocks.ravel()


def holds(packed: np.ndarray, values: np.ndarray, bits: int) -> np.ndarray:
    """Which of the values may be in the column."""
    at = cells(values, bits)
    return (packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def rows_in(batches: Iterator[pa.RecordBatch], key: str, packed: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """The rows whose long column ``key`` may be in the bitmap, a few at a time (their texts are copied); null keys go."""
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            some = batch.slice(start, _ROWS)
            keys = some.column(key)
            good = holds(packed, keys.fill_null(0).to_numpy(), bits) & keys.is_valid().to_numpy(zero_copy_only=False)
            if good.any():
                yield some.filter(pa.array(good))


def rows_that_may_be_in(table: DataFrame, key: str, packed: np.ndarray, bits: int) -> DataFrame:
    """``rows_in`` over a table."""
    shared = table.sparkSession.sparkContext.broadcast(packed)
    return table.mapInArrow(lambda batches: rows_in(batches, key, shared.value, bits), table.schema)
