"""Operator 3: exact top-k search by multi-resolution segment statistics.

A vector is split into 1, 4 and 16 equal segments; each segment is kept as its mean and deviation.  For segments of
s components, s * ((mean difference)^2 + (deviation difference)^2) summed over segments is a lower bound of the squared
distance of two vectors, hence of their inner product an upper bound: the sum of s * (mean * mean + deviation * deviation).
Candidates are pruned from coarse to fine with the k-th best exact score found so far, and survivors are scored exactly, in integers.

Queries and candidates meet in blocks of bounded size on both sides: candidates are spread over cells by a hash, queries too,
each pair of cells is one group, and only the k best of each cell go on to the last ranking.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import stored

SEGMENTS = (1, 4, 16)
CELL = 8_192
QUERY_CELL = 1_024


def segment_statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """For each vector the means and deviations of its segments, times the root of the segment's length."""
    out = []
    for part in np.array_split(vectors, min(segments, max(1, vectors.shape[1])), axis=1):
        root = np.sqrt(part.shape[1])
        out += [part.mean(axis=1) * root, part.std(axis=1) * root]
    return np.stack(out, axis=1)


def _matrix(table: pa.Table, dims: int) -> np.ndarray:
    return table.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dims)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


def search_cell(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The k best of one cell for each query: (query id, ids, scores)."""
    exact = np.int64
    if vectors.size and queries.size and float(np.abs(vectors).max()) * float(np.abs(queries).max()) * vectors.shape[1] < 2.0**53:
        exact = np.float64  # whole numbers below 2^53 stay exact and products are fast
    v, q = vectors.astype(exact), queries.astype(exact)
    levels = [(segment_statistics(vectors.astype(np.float64), s), segment_statistics(queries.astype(np.float64), s)) for s in SEGMENTS]
    slack = 1e-9 * (1 + float(np.abs(levels[0][0]).max(initial=0)) * float(np.abs(levels[0][1]).max(initial=0)) * vectors.shape[1])
    coarse = levels[0][1] @ levels[0][0].T
    for i in range(len(q)):
        bound = np.where(ids == query_ids[i], -np.inf, coarse[i])
        left = np.flatnonzero(bound > -np.inf)
        if len(left) > k:
            first = left[np.argpartition(-bound[left], k - 1)[:k]]
            floor = float((v[first] @ q[i]).min())  # k real scores: the k-th best is no lower
            left = left[bound[left] >= floor - slack]
            for stats, own in levels[1:]:
                finer = stats[left] @ own[i]
                if len(left) > 4 * k:  # a better floor from the best by the finer bound
                    first = left[np.argpartition(-finer, k - 1)[:k]]
                    floor = max(floor, float((v[first] @ q[i]).min()))
                left = left[finer >= floor - slack]
        scores = (v[left] @ q[i]).astype(np.int64)
        best = _best(scores, ids[left], k)
        yield query_ids[i], ids[left[best]], scores[best]


def _search(k: int):
    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        if queries.num_rows and candidates.num_rows:
            dims = queries.column("dims")[0].as_py()
            found = search_cell(
                _matrix(queries, dims), queries.column("vec_id").to_numpy(), _matrix(candidates, dims), candidates.column("vec_id").to_numpy(), k
            )
            for query, ids, scores in found:
                out[0].append(np.full(len(ids), query, np.int64))
                out[1].append(ids)
                out[2].append(scores)
        flat = [pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for x in out]
        return pa.Table.from_arrays(flat, ["query_id", "vec_id", "score"])

    return run


def top_k_inner_products(embeddings: DataFrame, is_query, k: int = 20, scale: int = 64) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its k highest integer inner products, ties to the smaller vec_id.

    Components become floor(scale * x), with x as double.  Rows without vec_id and vectors that are null, empty or hold null or non-finite
    components take no part; a vector is compared with those of its own length; rows that repeat a vec_id and its vector count once, and
    a query is never compared with rows of its own vec_id.
    """
    good = embeddings.filter("vec_id IS NOT NULL AND size(embedding) > 0").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: x.cast("double")).alias("x")
    ).filter(F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    whole = good.select("vec_id", F.transform("x", lambda x: F.floor(x * scale).cast("long")).alias("v"), F.size("x").alias("dims"))
    rows = stored(whole.dropDuplicates(["vec_id", "v"]))
    queries = rows.filter(is_query)
    cells = -(-max(1, rows.count()) // CELL)
    query_cells = -(-max(1, queries.count()) // QUERY_CELL)
    place = lambda n: F.pmod(F.xxhash64("vec_id", "v"), F.lit(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = queries.withColumn("qc", place(query_cells)).withColumn("cell", each(cells))
    right = rows.withColumn("cell", place(cells)).withColumn("qc", each(query_cells))
    by = ["dims", "cell", "qc"]
    near = left.groupBy(by).cogroup(right.groupBy(by)).applyInArrow(_search(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    ranked = near.withColumn("rank", rank).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
