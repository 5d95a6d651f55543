"""Operator 1: n-gram Jaccard join, size-aware with heavy and light sets.

A document is the set of its distinct five-word shingles.  Two sets link when their Jaccard
similarity is at least 4/5.  For sets of sizes a and b that needs 4(a+b)/9 common shingles, and
at least 4/5 of either set.  Shingles are ordered from rare to frequent by a fixed-size count
table of the whole corpus, so two linked sets share

* a shingle among the first ``n - ceil(4n/5) + 1`` of either, and
* a pair of shingles among the first ``n - ceil(4n/5) + 2`` of either.

Light sets enumerate those pairs (subsets of fixed size 2); heavy sets scan the inverted lists of
their first shingles, to which light sets near the boundary add themselves.  The boundary is the
size that makes the estimated number of enumerated subsets plus scanned list entries least.

Equal sets are one node from the start.  Within a list each set is first compared with one central
set of the list only, which joins large groups of near copies in linear work; after that every
remaining pair between different components, as far as positions in the order allow a link, is
compared exactly.  So the components are those of all links, and no group is expanded to all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bitmap import bitmap, rows_in
from .tables import components, stored
from .text import grams, lists, row_shingles, slices, words

COUNT_BITS = 20
_BLOCK = 4096
MAX_LIGHT = 256
ID_BITS = 23


def _element(shingles: np.ndarray) -> np.ndarray:
    return shingles >> np.uint64(8)


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << COUNT_BITS, np.int64)
    for batch in slices(batches):
        hashes, offsets = words(batch.column("text"))
        every = grams(hashes, 5)
        ends = np.zeros(len(hashes) + 1, bool)
        for k in range(4):  # a shingle does not run over the end of a text
            at = offsets[1:] - 1 - k
            ends[at[(at >= offsets[:-1]) & (at >= 0)]] = True
        counts += np.bincount((_element(every[~ends[: len(every)]]) & np.uint64((1 << COUNT_BITS) - 1)).astype(np.int64), minlength=len(counts))
    blocks = counts.reshape(-1, _BLOCK)
    used = np.flatnonzero(blocks.any(axis=1))
    if len(used):
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array([blocks[i].astype("<i8").tobytes() for i in used], pa.binary())], ["block", "counts"]
        )


def _add_counts(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: np.ndarray | int = 0
    block = None
    for t in tables:
        block = t.column("block")[0]
        for value in t.column("counts"):
            total = total + np.frombuffer(value.as_buffer(), "<i8")
    yield pa.RecordBatch.from_arrays([pa.array([block.as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["block", "counts"])


def rarity(docs: DataFrame) -> np.ndarray:
    """A level from 0 to 255 for each of the 2^20 cells of the corpus shingle counts (1 MB, whatever the corpus).

    Every task counts all its shingles into one table of fixed size; the tables are added block by
    block.  Cells are shared, so levels are upper bounds; any levels give right results, since they
    only set the order of shingles.
    """
    rows = docs.select("text").mapInArrow(_count_rows, "block int, counts binary").groupBy("block").applyInArrow(_add_counts, "block int, counts binary")
    counts = np.zeros((1 << COUNT_BITS) // _BLOCK * _BLOCK, np.int64).reshape(-1, _BLOCK)
    for row in rows.collect():  # at most a row a block
        counts[row.block] = np.frombuffer(bytes(row.counts), "<i8")
    counts = counts.ravel()
    return np.minimum(255, np.floor(7 * np.log2(1.0 + counts))).astype(np.uint8)


def _sorted_keys(hashes: np.ndarray, offsets: np.ndarray, levels: np.ndarray) -> Iterator[np.ndarray]:
    """Each row's distinct shingles as level and element in one number, rare first."""
    element = _element(grams(hashes, 5))
    cell = (element & np.uint64((1 << COUNT_BITS) - 1)).astype(np.int64)
    keys = (levels[cell].astype(np.uint64) << np.uint64(56)) | element
    for i in range(len(offsets) - 1):
        a, b = offsets[i], offsets[i + 1]
        if b - a >= 5:
            yield np.unique(keys[a : b - 4])
        else:
            one = _element(row_shingles(hashes, element, a, b))
            yield (levels[(one & np.uint64((1 << COUNT_BITS) - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | one


def _features(levels):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = levels.value
        noise = float(np.median(table))
        # an entry is compared with its list's centre, and with more of the list the longer it is
        cost = 1 + np.log2(np.maximum(1.0, 2.0 ** (np.arange(256) / 7) - 2.0 ** (noise / 7)))
        for batch in slices(batches):
            hashes, offsets = words(batch.column("text"))
            sizes, sums, xors, heads, scans = [], [], [], [], []
            for keys in _sorted_keys(hashes, offsets, table):
                n = len(keys)
                head = keys[: n // 5 + 2]
                sizes.append(n)
                spread = keys * np.uint64(0xD6E8FEB86659FD93)
                sums.append(int((spread ^ (spread >> np.uint64(32))).sum(dtype=np.uint64)))
                xors.append(int(np.bitwise_xor.reduce(keys * np.uint64(0xA0761D6478BD642F))) if n else 0)
                heads.append(head)
                scans.append(float(cost[(head[: n // 5 + 1] >> np.uint64(56)).astype(np.int64)].sum()))
            longs = lambda v: pa.array(np.array(v, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), longs(sums), longs(xors), lists([h.view(np.int64) for h in heads], pa.int64()), pa.array(scans, pa.float64())],
                ["doc_id", "n", "f1", "f2", "head", "scan"],
            )

    return run


def _sets(levels, wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(rows_in(batches, "doc_id", wanted.value, ID_BITS)):
            hashes, offsets = words(batch.column("text"))
            keys = [k.view(np.int64) for k in _sorted_keys(hashes, offsets, levels.value)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists(keys, pa.int64())], ["id", "elements"])

    return run


def boundary(stats: list[tuple[int, int, float, int]]) -> int:
    """The least set size that counts as heavy.

    ``stats`` has, by set size up to ``MAX_LIGHT``: the subsets its sets would enumerate, the list
    entries they would scan, and the list entries they add.
    """
    best, least = 4, None
    for x in range(4, MAX_LIGHT + 1):
        cost = sum(subsets if n < x else scan + own for n, subsets, scan, own in stats) + sum(own for n, _, _, own in stats if 4 * x <= 5 * n and n < x)
        if least is None or cost < least:
            best, least = x, cost
    return best


def signatures(sets: DataFrame, x: int) -> DataFrame:
    """Rows (sig, id, info): subsets of light sets (kind 0) and list entries of light (1) and heavy (2) sets.

    ``info`` packs the kind, the set's size and the place of the (last) shingle in its order, which goes into a list in that many bits.
    """
    info = "shiftleft(cast({kind} as long), 62) | shiftleft(n, 31) | ({place})"
    entry = f"inline(transform(slice(head, 1, cast(n div 5 + 1 as int)), (k, i) -> named_struct('sig', k, 'info', {info})))"
    pair = (
        "inline(flatten(transform(head, (k, i) -> transform(slice(head, i + 2, size(head)), (m, j) -> "
        f"named_struct('sig', xxhash64(k, m), 'info', {info.format(kind=0, place='i + j + 1')})))))"
    )
    heavy = sets.filter(F.col("n") >= x).selectExpr("id", entry.format(kind=2, place="i"))
    near = sets.filter((F.col("n") >= 4) & (F.col("n") < x) & (5 * F.col("n") >= 4 * x)).selectExpr("id", entry.format(kind=1, place="i"))
    light = sets.filter((F.col("n") >= 4) & (F.col("n") < x)).selectExpr("id", pair)
    return heavy.unionByName(near).unionByName(light)


_UNPACK = {"kind": "cast(shiftrightunsigned(info, 62) as int)", "n": "shiftrightunsigned(info, 31) & 2147483647", "pos": "info & 2147483647"}
#: How many shingles a set can share with another if this entry is their first common one (for pairs: the first two).
_BOUND = "n - pos + if(kind = 0, 1, 0)"
_MAY_LINK = "9 * least({l}.bound, {r}.bound) >= 4 * ({l}.n + {r}.n) AND NOT ({l}.kind = 1 AND {r}.kind = 1)"


def _linked(pairs: DataFrame, docs: DataFrame, levels) -> DataFrame:
    """The pairs whose whole shingle sets have similarity 4/5 or more; only documents in a pair are read in full."""
    ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap(ids, "doc_id", ID_BITS))
    some = docs.mapInArrow(_sets(levels, wanted), "id long, elements array<long>")
    sets = stored(some.join(ids.withColumnRenamed("doc_id", "id"), "id", "left_semi"))
    left = sets.select(F.col("id").alias("a"), F.col("elements").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("elements").alias("y"))
    both = pairs.join(left, "a").join(right, "b")
    return both.filter("9 * size(array_intersect(x, y)) >= 4 * (size(x) + size(y))").select("a", "b")


def ngram_jaccard_components(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``documents`` (doc_id, text; other columns are ignored).

    Texts that are null, empty or without words have no shingles and link with nothing.  Rows with
    equal shingle sets are linked.  Rows that repeat a doc_id are one node, since a component holds
    doc_ids.  A row without doc_id links with nothing and has a null component.
    Shingles are compared by 56-bit hashes.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    levels = docs.sparkSession.sparkContext.broadcast(rarity(docs))
    rows = stored(docs.mapInArrow(_features(levels), "doc_id long, n long, f1 long, f2 long, head array<long>, scan double"))

    known = rows.filter("doc_id IS NOT NULL AND n > 0")
    nodes = known.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("id"))
    sets = known.join(nodes.withColumnRenamed("id", "doc_id"), ["n", "f1", "f2", "doc_id"]).dropDuplicates(["n", "f1", "f2"]).select(F.col("doc_id").alias("id"), "n", "head", "scan")
    sets = stored(sets)
    size = F.least(F.col("n"), F.lit(MAX_LIGHT)).alias("size")
    head = F.size("head").cast("long")
    stats = sets.groupBy(size).agg(F.sum(head * (head - 1) / 2), F.sum("scan"), F.sum(head - 1)).collect()  # MAX_LIGHT rows at most
    x = boundary([tuple(r) for r in stats])

    rows_by_sig = signatures(sets, x)
    # aggregates are stored before they are joined back, so that a long list's partition can be split in the join
    common = stored(rows_by_sig.groupBy("sig").count().filter("count > 1").select("sig"))
    entries = rows_by_sig.join(common, "sig")
    for name, value in _UNPACK.items():
        entries = entries.withColumn(name, F.expr(value))
    entries = stored(entries.withColumn("bound", F.expr(_BOUND)).drop("info"))
    # the centre of a list: heavy before light, then the set with the fewest rarer shingles
    order = F.expr("shiftleft(cast(2 - kind as long), 60) | shiftleft(pos, 28) | (xxhash64(id) & 268435455)")
    centre = stored(entries.withColumn("o", order).groupBy("sig").agg(
        F.max("kind").alias("top"), *[F.min_by(c, "o").alias(c) for c in ("id", "n", "bound", "kind")]
    ).filter("top <> 1"))
    shared = stored(
        entries.alias("r").join(centre.alias("l"), "sig").select(
            "sig", "r.id", "r.n", "r.bound", "r.kind", F.when(F.expr(f"l.id <> r.id AND {_MAY_LINK.format(l='l', r='r')}"), F.col("l.id")).alias("centre")
        )
    )
    first = shared.filter("centre IS NOT NULL").select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct()
    edges = stored(_linked(stored(first), docs, levels))
    found = components(edges)

    # what is left between different components
    where = shared.join(found.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id")).drop("centre")
    mixed = stored(where.groupBy("sig").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("sig"))
    open_rows = where.join(mixed, "sig")
    l, r = open_rows.alias("l"), open_rows.alias("r")
    rest = l.join(r, F.expr(f"l.sig = r.sig AND l.id < r.id AND l.component <> r.component AND {_MAY_LINK.format(l='l', r='r')}")).select(
        F.col("l.id").alias("a"), F.col("r.id").alias("b")
    ).distinct()
    more = _linked(stored(rest), docs, levels)
    joined = components(
        edges.union(more).union(known.join(nodes, ["n", "f1", "f2"]).filter("doc_id <> id").select(F.col("id").alias("a"), F.col("doc_id").alias("b")))
    )
    return rows.select("doc_id", F.col("n").alias("n_shingles")).join(
        joined.withColumnRenamed("node", "doc_id"), "doc_id", "left"
    ).select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def keep_one_per_group(documents: DataFrame, other_versions: DataFrame | None = None) -> DataFrame:
    """``documents`` with one row of each group of near copies, that with the smallest doc_id.

    ``other_versions`` (doc_id, text) are further texts of some of the documents, such as the whole text where parts were cut: two documents are
    near copies if any of their versions are.  Rows without doc_id stay; of rows that repeat a doc_id one stays, which one is free if they differ.
    """
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if other_versions is not None:
        texts = texts.unionByName(other_versions.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    kept = ngram_jaccard_components(texts).filter("doc_id = component_id").select("doc_id").distinct()
    named = documents.filter("doc_id IS NOT NULL").join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.select(documents.columns).unionByName(documents.filter("doc_id IS NULL"))
