"""Operator 12: centroid clustering with a VA-file.

Every dimension is cut into a few cells (``2^bits``) at quantiles of the whole table, and a vector is kept twice: as its cell
numbers, a byte a dimension, and in full.  For each centroid a lookup table holds the least and the greatest squared distance of every cell of
every dimension to it; summed over the dimensions they bound the distance from both sides.  A centroid whose least distance exceeds
another's greatest cannot be nearest.  Where one centroid is left the vector is assigned without being looked at; only the
others are fetched in full and measured, in integers.

The sums of the clusters change only by the vectors that moved, so after the first round those alone are fetched for them.
A round is one pass over the table; what comes back is at most one row a centroid and dimension.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored

#: Integers beyond this would let a squared distance pass 64 bits.
LARGEST = 1 << 27
CHUNK = 1_024


@dataclass(frozen=True)
class Clustering:
    """``assigned`` has vec_id, cluster, distance and ``candidates`` (how many centroids the intervals left in the last assignment);
    ``centroids`` are the final ones, ``fetched`` says of each pass for how many vectors the intervals did not decide."""

    assigned: DataFrame
    centroids: list[list[int]]
    fetched: list[int]


class Intervals:
    """Lookup tables of one set of centroids over the cells of all dimensions."""

    def __init__(self, centroids: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.centroids = centroids  # k x dims
        under = low[:, :, None] - centroids.T[:, None, :]  # dims x cells x k
        over = centroids.T[:, None, :] - high[:, :, None]
        self.least = np.maximum(np.maximum(under, over), 0) ** 2
        self.most = np.maximum(np.abs(under), np.abs(over)) ** 2

    def left(self, codes: np.ndarray) -> np.ndarray:
        """Which centroids (columns) may be nearest to the vectors of these cells (rows)."""
        least = np.zeros((len(codes), len(self.centroids)), np.int64)
        most = np.zeros_like(least)
        for d in range(codes.shape[1]):
            least += self.least[d][codes[:, d]]
            most += self.most[d][codes[:, d]]
        return least <= most.min(axis=1, keepdims=True)

    def nearest(self, codes: np.ndarray, fetch) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of each vector, ties to the smaller number, and how many were left; ``fetch(rows)`` gives full vectors."""
        left = self.left(codes)
        counts = left.sum(axis=1)
        cluster = left.argmax(axis=1)
        open_rows = np.flatnonzero(counts > 1)
        if len(open_rows):
            exact = self.distances(fetch(open_rows))
            exact[~left[open_rows]] = np.iinfo(np.int64).max
            cluster[open_rows] = exact.argmin(axis=1)
        return cluster, counts

    def distances(self, vectors: np.ndarray) -> np.ndarray:
        out = np.empty((len(vectors), len(self.centroids)), np.int64)
        for k, centre in enumerate(self.centroids):
            out[:, k] = ((vectors - centre) ** 2).sum(axis=1)
        return out


def _matrix(column: pa.Array, dims: int, kind) -> np.ndarray:
    """Rows of a binary column of equal lengths, without a copy."""
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int32, len(column) + 1, column.offset * 4)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(kind).reshape(-1, dims)


def _chunks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, CHUNK):
            some = batch.slice(start, CHUNK)
            yield some.column("vec_id"), _matrix(some.column("code"), dims, np.uint8), _matrix(some.column("full"), dims, np.int32)


def _encode(edges: np.ndarray):
    """Cell numbers and full vectors of rows (vec_id, v); ``edges`` are dims x (cells - 1), a value at an edge lies above it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v").flatten().to_numpy().reshape(batch.num_rows, -1)
            codes = np.empty(v.shape, np.uint8)
            for d in range(v.shape[1]):
                codes[:, d] = np.searchsorted(edges[d], v[:, d], side="right")
            full = v.astype("<i4")
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([r.tobytes() for r in codes], pa.binary()), pa.array([r.tobytes() for r in full], pa.binary())],
                ["vec_id", "code", "full"],
            )

    return run


def _moves(shared, dims: int):
    """Changes of counts and sums from the assignment by the centroids before to that by the present ones: (cluster, dim, change).

    Dim -1 is the number of vectors, dim -2 that of the vectors whose intervals did not decide.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, now = shared.value
        k = len(now.centroids)
        sums, counts, fetched = np.zeros((k, dims), np.int64), np.zeros(k, np.int64), 0
        for _, codes, full in _chunks(batches, dims):
            fetch = lambda rows, full=full: full[rows].astype(np.int64)
            new, left = now.nearest(codes, fetch)
            fetched += int((left > 1).sum())
            old = before.nearest(codes, fetch)[0] if before is not None else np.full(len(new), -1)
            moved = np.flatnonzero(new != old)
            vectors = fetch(moved)
            np.add.at(sums, new[moved], vectors)
            np.add.at(counts, new[moved], 1)
            if before is not None:
                np.subtract.at(sums, old[moved], vectors)
                np.subtract.at(counts, old[moved], 1)
        table = np.concatenate([counts[:, None], sums], axis=1)
        at = np.argwhere(table != 0)
        rows = [*((int(c), int(d) - 1, int(table[c, d])) for c, d in at), (0, -2, fetched)]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int64()), strict=True)], ["cluster", "dim", "change"])

    return run


def _final(shared, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = shared.value
        for ids, codes, full in _chunks(batches, dims):
            cluster, left = now.nearest(codes, lambda rows, full=full: full[rows].astype(np.int64))
            distance = ((full - now.centroids[cluster]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(cluster.astype(np.int32)), pa.array(distance), pa.array(left.astype(np.int32))], ["vec_id", "cluster", "distance", "candidates"]
            )

    return run


def whole_vectors(embeddings: DataFrame, dims: int, scale: int) -> DataFrame:
    """(vec_id, v array<int>) of the rows whose embedding has ``dims`` components, none null or non-finite: floor(scale * x), x as double."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    good = embeddings.filter(F.size("embedding") == dims).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).filter(
        F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    )
    too_large = F.raise_error(F.lit(f"a component is beyond {LARGEST} / {scale}: squared distances would not fit 64 bits")).cast("int")
    cell = lambda c: F.when(F.abs(c * scale) < LARGEST, F.floor(c * scale).cast("int")).otherwise(too_large)
    return good.select("vec_id", F.transform("x", cell).alias("v"))


def cells_of(vectors: DataFrame, dims: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Edges (dims x cells-1) at quantiles of all vectors, and the least and greatest value of each cell; None without vectors."""
    cells = 1 << bits
    shares = [i / cells for i in range(1, cells)]
    at = [F.col("v")[d] for d in range(dims)]
    row = vectors.agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.min(c) for c in at]).alias("low"), F.array(*[F.max(c) for c in at]).alias("high"),
        F.array(*[F.percentile_approx(c, shares, 1_000) for c in at]).alias("edges"),
    ).first()
    if not row["n"]:
        return None
    edges = np.array(row["edges"], np.int64)
    low = np.concatenate([np.array(row["low"], np.int64)[:, None], edges], axis=1)
    high = np.concatenate([edges - 1, np.array(row["high"], np.int64)[:, None]], axis=1)
    return edges, low, np.maximum(high, low)


def first_centroids(vectors: DataFrame, k: int, salt: str) -> list[list[int]]:
    """The k vectors with the smallest lower-case hex sha256 of ``<salt>:<vec_id>``; rows that tie by their values, null ids last."""
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    return [list(r["v"]) for r in vectors.orderBy(key.asc_nulls_last(), "v").limit(k).select("v").collect()]


def cluster_vectors(embeddings: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, bits: int = 4, salt: str = "2") -> Clustering:
    """Clusters of integer vectors by ``rounds`` rounds of nearest centroids and componentwise floor(sum / count).

    Vectors with another number of components, or with null or non-finite ones, take no part; an empty table gives an empty result;
    with fewer than ``k`` vectors each is a first centroid.  Rows that repeat a vec_id are vectors of their own, a null vec_id is the last
    choice as first centroid.  Equal distances go to the smaller cluster number; empty clusters keep their centroid.
    A component whose size makes distances pass 64 bits is an error, never a wrong number.
    """
    spark = embeddings.sparkSession
    vectors = stored(whole_vectors(embeddings, dims, scale))
    cells = cells_of(vectors, dims, bits)
    if cells is None:
        return Clustering(spark.createDataFrame([], "vec_id long, cluster int, distance long, candidates int"), [], [])
    edges, low, high = cells
    table = stored(vectors.mapInArrow(_encode(edges), "vec_id long, code binary, full binary"))
    centroids = first_centroids(vectors, k, salt)
    k = len(centroids)
    sums, counts = [[0] * dims for _ in range(k)], [0] * k
    before, fetched = None, []
    for _ in range(rounds):
        now = Intervals(np.array(centroids, np.int64), low, high)
        shared = spark.sparkContext.broadcast((before, now))
        moved = table.mapInArrow(_moves(shared, dims), "cluster int, dim int, change long").groupBy("cluster", "dim").agg(F.sum("change").alias("change"))
        fetched.append(0)
        for r in moved.collect():  # at most k * (dims + 1) + 1 rows
            if r["dim"] == -2:
                fetched[-1] = r["change"]
            elif r["dim"] == -1:
                counts[r["cluster"]] += r["change"]
            else:
                sums[r["cluster"]][r["dim"]] += r["change"]
        centroids = [[s // counts[c] for s in sums[c]] if counts[c] else centroids[c] for c in range(k)]
        before = now
    shared = spark.sparkContext.broadcast(Intervals(np.array(centroids, np.int64), low, high))
    assigned = stored(table.mapInArrow(_final(shared, dims), "vec_id long, cluster int, distance long, candidates int"))
    fetched.append(assigned.filter("candidates > 1").count())
    return Clustering(assigned, centroids, fetched)
