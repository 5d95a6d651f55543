"""Operator 7: benchmark decontamination by size-partitioned MinHash containment search.

Test items are short and documents long, so the Jaccard similarity of an item and a whole document says
little.  Items are put in partitions by the number of their five-word shingles (upper bounds grow by a
quarter); for each partition a document is seen as overlapping windows of 2.5 times its bound, so that an item and
the window that holds it differ in size by a known factor, and ``PERMUTATIONS`` single-row MinHash bands find
at least 99.99 % of the windows that hold four fifths of an item.  Candidates are verified by the exact share
of the item's shingles in the document.

Before windows are signed, a bitmap of all items' shingles (fixed size, so it can go to every task) rules out windows
that hold too few of them for any item of the partition; bits can be shared, so that loses nothing.

MinHash decides wherever an item's shingles lie within a window.  An item that is spread over more than that has no window to be found
in; it is found by its rarest shingles: a document with four fifths of n shingles holds at least one of any n - ceil(0.8 n) + 1 of
them, so the ones that fewest documents hold are joined with the documents' hits, and what stands in one window is left to MinHash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bitmap import bitmap, holds
from .tables import stored
from .text import SHINGLE_WORDS, grams, lists, mix, slices, words

CONTAINMENT = 0.8
PERMUTATIONS = 48
BITMAP_BITS = 22
GROWTH = 1.25
_SEEDS = mix(np.arange(1, PERMUTATIONS + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) | np.uint64(1)


def partition_of(n: int) -> int:
    """Partition of an item with n shingles."""
    return max(0, math.ceil(math.log(max(n, 1)) / math.log(GROWTH) - 1e-9))


def largest(partition: int) -> int:
    """Most shingles of an item of the partition."""
    return math.floor(GROWTH**partition + 1e-9)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Least value of a shingle set under each permutation."""
    return mix(shingles[None, :] * _SEEDS[:, None]).min(axis=1)


def _keys(partition: int, least: np.ndarray) -> np.ndarray:
    return mix(least + mix(np.arange(PERMUTATIONS, dtype=np.uint64) + np.uint64(partition * PERMUTATIONS + 1)))


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        hashes, offsets = words(batch.column("text"))
        every = grams(hashes, SHINGLE_WORDS)
        rows, sets, keys, part = [], [], [], []
        for i in range(batch.num_rows):
            own = np.unique(every[offsets[i] : max(offsets[i], offsets[i + 1] - SHINGLE_WORDS + 1)])
            if len(own):
                rows.append(i)
                sets.append(own.view(np.int64))
                part.append(partition_of(len(own)))
                keys.append(_keys(part[-1], signature(own)).view(np.int64))
        if rows:
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id").take(pa.array(rows)), lists(sets, pa.int64()), pa.array(part, pa.int32()), lists(keys, pa.int64())],
                ["item_id", "shingles", "part", "keys"],
            )


def _windows(parts: list[int], in_items, in_keys):
    least = math.ceil(CONTAINMENT * (largest(parts[0] - 1) + 1 if parts and parts[0] else 1) - 1e-9)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes, offsets = words(batch.column("text"))
            every = grams(hashes, SHINGLE_WORDS)
            hit = holds(in_items.value, every, BITMAP_BITS)
            hits = np.concatenate(([0], np.cumsum(hit)))
            rows, found, held, places = [], [], [], []
            for i in range(batch.num_rows):
                a, b = offsets[i], offsets[i + 1] - SHINGLE_WORDS + 1
                if b <= a or hits[b] == hits[a]:
                    continue
                own: set[int] = set()
                for p in parts:
                    step = largest(p)
                    begin = np.arange(a, max(a + 1, math.ceil(b - 1.5 * step)), step)
                    end = np.minimum(b, begin + math.ceil(2.5 * step))
                    need = math.ceil(CONTAINMENT * (largest(p - 1) + 1 if p else 1) - 1e-9)
                    for k in np.flatnonzero(hits[end] - hits[begin] >= need):
                        keys = _keys(p, signature(every[begin[k] : end[k]]))
                        own.update(keys[holds(in_keys.value, keys, BITMAP_BITS)].view(np.int64).tolist())
                distinct, first = np.unique(every[a:b][hit[a:b]], return_index=True)
                if own or len(distinct) >= least:
                    rows.append(i)
                    found.append(np.array(sorted(own), np.int64))
                    held.append(distinct.view(np.int64))
                    places.append(np.flatnonzero(hit[a:b])[first])
            if rows:
                columns = [lists(found, pa.int64()), lists(held, pa.int64()), lists(places, pa.int32())]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(rows)), *columns], ["doc_id", "keys", "held", "places"])

    return run


def _by_rare_shingles(hits: DataFrame, items: DataFrame) -> DataFrame:
    """(row, item_id) of all documents that hold one of the rarest shingles of an item and hits enough for four fifths of it."""
    held = hits.select("row", F.size("held").alias("most"), F.explode("held").alias("shingle"))
    each = items.withColumn("item", F.monotonically_increasing_id()).select("item", "item_id", F.explode("shingles").alias("shingle"))
    # both are stored before they are joined, so that a frequent shingle's partition can be split in the join
    seen = stored(held.groupBy("shingle").agg(F.count("*").alias("seen")))
    ranked = (
        each.join(seen, "shingle", "left").groupBy("item", "item_id")
        .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "shingle"))).alias("order"))
        .withColumn("need", F.ceil(CONTAINMENT * F.size("order") - 1e-9).cast("int"))
    )
    rare = stored(ranked.select("item_id", "need", F.explode(F.expr("slice(order, 1, size(order) - need + 1)")).alias("x")).filter("x.seen > 0").select("item_id", "need", F.col("x.shingle").alias("shingle")))
    return held.join(rare, "shingle").filter("most >= need").select("row", "item_id")


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, containment) of documents (doc_id, text) that hold four fifths or more of a benchmark item (item_id, text).

    Containment is the share of the item's distinct five-word shingles that occur in the document.  Items with fewer than
    five words, null texts and rows without an id take no part.  Rows that repeat an id with other texts count with the
    best of them.  An item counts wherever its shingles stand in the document.
    """
    items = stored(
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("item_id IS NOT NULL").mapInArrow(_items, "item_id long, shingles array<long>, part int, keys array<long>")
    )
    parts = [r.part for r in items.select("part").distinct().orderBy("part").collect()]  # about 10 for each tenfold size
    broadcast = documents.sparkSession.sparkContext.broadcast
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id IS NOT NULL")
    run = _windows(parts, broadcast(bitmap(items, "shingles", BITMAP_BITS)), broadcast(bitmap(items, "keys", BITMAP_BITS)))
    hits = stored(docs.mapInArrow(run, "doc_id long, keys array<long>, held array<long>, places array<int>").withColumn("row", F.monotonically_increasing_id()))
    by_window = (
        hits.select("row", F.explode("keys").alias("key"))
        .join(items.select("item_id", F.explode("keys").alias("key")), "key").select("row", "item_id")
    )
    both_ways = by_window.withColumn("window", F.lit(True)).union(_by_rare_shingles(hits, items).withColumn("window", F.lit(False)))
    pairs = both_ways.groupBy("row", "item_id").agg(F.max("window").alias("window"))
    both = pairs.join(items.select("item_id", "shingles", "part"), "item_id").join(hits.select("row", "doc_id", "held", "places"), "row")
    share = F.size(F.array_intersect("shingles", "held")) / F.size("shingles")
    alike = both.withColumn("containment", share).filter(F.col("containment") >= CONTAINMENT)
    whole = alike.filter(F.col("window") | _spread()).select("doc_id", "item_id", "containment")
    return whole.groupBy("doc_id", "item_id").agg(F.max("containment").alias("containment"))


def _spread() -> Column:
    """Whether the item's shingles in the document lie further apart than any window is sure to reach."""
    own = F.filter(F.arrays_zip("held", "places"), lambda x: F.array_contains("shingles", x["held"]))
    at = F.transform(own, lambda x: x["places"])
    reach = F.floor(F.pow(F.lit(GROWTH), F.col("part")) + 1e-9) * 1.5
    return F.array_max(at) - F.array_min(at) + 1 > reach


def without_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` without the rows whose doc_id holds a benchmark item; columns as they were."""
    bad = contaminated(documents, benchmark).select("doc_id").distinct()
    return documents.join(bad, "doc_id", "left_anti").select(documents.columns)
