"""Operator 2: line dedup by pairwise alignment.

A run is the least number of neighbouring lines, blank ones left out, that hold ``MIN_BLOCK_CHARS`` characters, taken forwards
and backwards from every line.  Every line of a block lies in a run inside the block: the run that starts with the block or the one
that ends with the line.  Every distinct run has a first holder, the smallest doc_id that has it, and a later document is paired with
the first holders of its runs; so no block is without a partner, whatever the frequency or age of its single lines, and pairs grow
with the lines and not with the square of a line's frequency.  Each pair is aligned with a patience diff, and aligned common
blocks of ``MIN_BLOCK_CHARS`` or more are deleted from the later document.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bitmap import bitmap, rows_that_may_be_in
from .tables import stored
from .text import mix

MIN_BLOCK_CHARS = 60
#: A document that has less than this share of its characters left is also compared by its whole text.
MOST_LEFT = 0.7
ID_BITS = 24
#: White space that may stand around a line.
_AROUND = " \t\x0b\x0c\r"
_BASE = 0x9E3779B97F4A7C15
_BACK = np.uint64(pow(_BASE, -1, 1 << 64))


def run_keys(hashes: np.ndarray, lengths: np.ndarray, row: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, key and number of lines of every run of the non-blank lines of some texts; ``row`` says which text a line is of."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    chars = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
    at = np.arange(n)
    # forwards from each line, then backwards; ends are excluded
    ahead = np.maximum(at + 1, np.searchsorted(chars, chars[:-1] + least))
    behind = np.minimum(at, np.searchsorted(chars, chars[1:] - least, side="right") - 1)
    lo, hi = np.concatenate((at, behind)), np.concatenate((ahead, at + 1))
    inside = (lo >= 0) & (hi <= n)
    lo, hi = lo[inside], hi[inside]
    same = row[lo] == row[hi - 1]
    lo, hi = np.divmod(np.unique(lo[same] * (n + 1) + hi[same]), n + 1)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n - 1, np.uint64(_BASE)))), dtype=np.uint64)
        back = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n - 1, _BACK))), dtype=np.uint64)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(hashes) * power, dtype=np.uint64)))
        keys = mix((total[hi] - total[lo]) * back[lo] + (hi - lo).astype(np.uint64))
    return row[lo], keys, hi - lo


def _runs(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, lengths = batch.column("hashes"), batch.column("lengths")
            row = np.repeat(np.arange(batch.num_rows), hashes.value_lengths().to_numpy())
            flat = hashes.flatten()
            filled = flat.is_valid().to_numpy(zero_copy_only=False)
            row, keys, size = run_keys(
                flat.drop_null().to_numpy().view(np.uint64), lengths.flatten().to_numpy()[filled], row[filled], least
            )
            order = np.lexsort((keys, row))
            again = (np.diff(row[order]) == 0) & (np.diff(keys[order]) == 0)
            once = np.delete(order, np.flatnonzero(again) + 1)
            take = pa.array(row[once])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(take), batch.column("mark").take(take), pa.array(keys[once].view(np.int64)), pa.array(size[once] == 1)],
                ["doc_id", "mark", "run", "single"],
            )

    return run


def _anchors(a: list, b: list, a_lo: int, a_hi: int, b_lo: int, b_hi: int) -> list[tuple[int, int]]:
    """Longest increasing run of lines that occur once in either range and in both."""
    in_a, in_b = Counter(a[a_lo:a_hi]), Counter(b[b_lo:b_hi])
    where = {a[i]: i for i in range(a_lo, a_hi) if a[i] is not None and in_a[a[i]] == 1}
    tails: list[int] = []
    nodes: list[tuple[int, int, int]] = []  # place in a, place in b, previous node
    tops: list[int] = []
    for j in range(b_lo, b_hi):
        i = where.get(b[j])
        if i is None or in_b[b[j]] != 1:
            continue
        pile = bisect_left(tails, i)
        nodes.append((i, j, tops[pile - 1] if pile else -1))
        if pile == len(tails):
            tails.append(i)
            tops.append(len(nodes) - 1)
        else:
            tails[pile], tops[pile] = i, len(nodes) - 1
    found, at = [], tops[-1] if tops else -1
    while at >= 0:
        i, j, at = nodes[at]
        found.append((i, j))
    return found[::-1]


def patience_matches(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned equal lines (place in a, place in b) of a patience diff, in order; a line that is None matches nothing."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a_lo, a_hi, b_lo, b_hi = todo.pop()
        while a_lo < a_hi and b_lo < b_hi and a[a_lo] is not None and a[a_lo] == b[b_lo]:
            out.append((a_lo, b_lo))
            a_lo, b_lo = a_lo + 1, b_lo + 1
        while a_lo < a_hi and b_lo < b_hi and a[a_hi - 1] is not None and a[a_hi - 1] == b[b_hi - 1]:
            a_hi, b_hi = a_hi - 1, b_hi - 1
            out.append((a_hi, b_hi))
        if a_lo >= a_hi or b_lo >= b_hi:
            continue
        last = (a_lo, b_lo)
        found = _anchors(a, b, a_lo, a_hi, b_lo, b_hi)
        for i, j in found:
            out.append((i, j))
            todo.append((last[0], i, last[1], j))
            last = (i + 1, j + 1)
        if found:
            todo.append((last[0], a_hi, last[1], b_hi))
    return sorted(out)


def common_blocks(a: list, b: list, lengths: list[int], least: int) -> list[int]:
    """Lines of b in aligned blocks that hold ``least`` characters or more; blank lines (None) between two lines of a block belong to it."""
    cut: list[int] = []
    block: list[int] = []
    last = None
    for i, j in [*patience_matches(a, b), (None, None)]:
        joined = (
            last is not None and i is not None
            and all(x is None for x in a[last[0] + 1 : i]) and all(x is None for x in b[last[1] + 1 : j])
        )
        if block and not joined:
            if sum(lengths[k] for k in block) >= least:
                cut += range(block[0], block[-1] + 1)
            block = []
        if i is not None:
            block.append(j)
            last = (i, j)
    return cut


def _align(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = [
                common_blocks(x.as_py(), y.as_py(), n.as_py(), least)
                for x, y, n in zip(batch.column("x"), batch.column("y"), batch.column("lengths"), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), pa.array(cuts, pa.list_(pa.int32()))], ["doc_id", "mark", "cut"])

    return run


def _lines(text: str) -> Column:
    return F.split(text, "\n")


def repeated_lines(documents: DataFrame, rare: int | None = None, min_block_chars: int = MIN_BLOCK_CHARS) -> DataFrame:
    """(doc_id, mark, cut): line numbers (from 0) to delete of each document that repeats blocks of an earlier one.

    ``mark`` is the hash of the text the numbers belong to.  Lines are compared without white space around them; blank lines match nothing.
    A caller who gives ``rare`` has no pairs made by one line alone, however long, that more than ``rare`` documents have.
    """
    has = documents.filter("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    trimmed = F.transform(_lines("text"), lambda line: F.btrim(line, F.lit(_AROUND)))
    lines = stored(
        has.withColumn("mark", F.xxhash64("text")).withColumn("trimmed", trimmed).select(
            "doc_id", "mark",
            F.transform("trimmed", lambda line: F.when(line != "", F.xxhash64(line))).alias("hashes"),
            F.transform("trimmed", lambda line: F.length(line)).alias("lengths"),
        ).dropDuplicates(["doc_id", "mark"])
    )
    each = lines.mapInArrow(_runs(min_block_chars), "doc_id long, mark long, run long, single boolean")
    # stored before it is joined back, so that a frequent run's partition can be split in the join
    first = stored(each.groupBy("run").agg(F.min("doc_id").alias("holder"), F.count("*").alias("held")).filter("held > 1"))
    met = each.join(first, "run").filter("doc_id > holder")
    if rare is not None:
        met = met.filter(~F.col("single") | (F.col("held") <= rare))
    pairs = met.select("doc_id", "mark", "holder").distinct()
    both = (
        pairs.join(lines.select(F.col("doc_id").alias("holder"), F.col("hashes").alias("x")), "holder")
        .join(lines.select("doc_id", "mark", F.col("hashes").alias("y"), "lengths"), ["doc_id", "mark"])
    )
    cuts = both.select("doc_id", "mark", "x", "y", "lengths").mapInArrow(_align(min_block_chars), "doc_id long, mark long, cut array<int>")
    return cuts.filter("size(cut) > 0").groupBy("doc_id", "mark").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("cut")))).alias("cut"))


def without_repeated_lines(documents: DataFrame, rare: int | None = None, min_block_chars: int = MIN_BLOCK_CHARS) -> DataFrame:
    """``documents`` (doc_id, text, ...) with repeated blocks deleted from the later documents; ``n_chars``, if there, follows.

    Every row stays, with its columns in order; a text that only repeats others is left empty or blank.
    Null texts and rows without doc_id stay as they are.  Rows that repeat a doc_id are never cut for one another.
    """
    cuts = repeated_lines(documents, rare, min_block_chars).select(F.col("doc_id").alias("_cut_doc"), F.col("mark").alias("_cut_mark"), F.col("cut").alias("_cut"))
    joined = documents.join(cuts, (F.col("doc_id") == F.col("_cut_doc")) & (F.xxhash64("text") == F.col("_cut_mark")), "left")
    left = F.filter(_lines("text"), lambda line, i: ~F.array_contains("_cut", i))
    text = F.when(F.col("_cut").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    out = joined.withColumn("text", text)
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.when(F.col("_cut").isNull(), F.col("n_chars")).otherwise(F.length("text")))
    return out.select(documents.columns)


def uncut_texts(documents: DataFrame, originals: DataFrame, most_left: float = MOST_LEFT) -> DataFrame:
    """(doc_id, text): whole texts, in ``originals``, of the documents that lost more than ``1 - most_left`` of their characters to cuts.

    A row of ``originals`` counts if it has the document's doc_id and all lines of the document are lines of it.  Rows without doc_id or
    text take no part.  Lengths alone say which documents these are, and only their texts are shuffled.
    """
    has = "doc_id IS NOT NULL AND text IS NOT NULL"
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    now, before = documents.filter(has).select(doc_id, "text"), originals.filter(has).select(doc_id, "text")
    left = now.groupBy("doc_id").agg(F.min(F.length("text")).alias("left"))
    whole = before.groupBy("doc_id").agg(F.max(F.length("text")).alias("whole"))
    ids = stored(left.join(whole, "doc_id").filter(F.col("left") < most_left * F.col("whole")).select("doc_id"))
    packed = bitmap(ids, "doc_id", ID_BITS)
    some = lambda df: rows_that_may_be_in(df, "doc_id", packed, ID_BITS)
    cut = some(now).join(ids, "doc_id", "left_semi").withColumnRenamed("text", "left_over")
    inside = F.size(F.array_except(_lines("left_over"), _lines("text"))) == 0
    return stored(some(before).join(cut, "doc_id").filter(inside).select("doc_id", "text").distinct())
