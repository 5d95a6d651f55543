from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from kerbside.llm import vafile as m

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("cluster", T.StringType())])


def brute(data: list, k: int, rounds: int, dims: int) -> tuple[list, list]:
    """Every vector against every centroid in Python integers: sorted (vec_id, cluster, distance), and the centroids."""
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in data
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1])
    centres = [list(v) for _, v in sorted(good, key=key)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        groups: dict = {}
        for _, v in good:
            groups.setdefault(nearest(v)[1], []).append(v)
        centres = [[sum(x) // len(x) for x in zip(*groups[n], strict=True)] if n in groups else c for n, c in enumerate(centres)]
    found = [(i, nearest(v)[1], nearest(v)[0]) for i, v in good]
    return sorted(found, key=lambda r: (r[0] is None, r)), centres


def run(spark, data: list, **options):
    found = m.cluster_vectors(spark.createDataFrame([(i, v, "x") for i, v in data], SCHEMA), **options)
    rows = [(r["vec_id"], r["cluster"], r["distance"]) for r in found.assigned.collect()]
    return sorted(rows, key=lambda r: (r[0] is None, r)), found


def grouped(n: int, dims: int, groups: int, seed: int = 1) -> list:
    r = random.Random(seed)
    centres = [[r.gauss(0, 0.3) for _ in range(dims)] for _ in range(groups)]
    return [(i, [x + r.gauss(0, 0.04) for x in centres[i % groups]]) for i in range(n)]


@pytest.mark.parametrize("bits", [1, 4])
def test_equals_brute_force(spark, bits):
    data = grouped(300, 64, 12)
    expected, centres = brute(data, 40, 5, 64)
    rows, found = run(spark, data, bits=bits)
    assert rows == expected and found.centroids == centres


def test_intervals_spare_full_vectors(spark):
    data = grouped(400, 64, 8)
    _, found = run(spark, data, k=8)
    assert len(found.fetched) == 6
    assert min(found.fetched) < 400


def test_intervals_hold():
    r = np.random.default_rng(3)
    v = r.integers(-200, 200, (500, 6))
    edges = np.sort(r.integers(-150, 150, (6, 7)), axis=1)
    low = np.concatenate([v.min(axis=0)[:, None], edges], axis=1)
    high = np.maximum(np.concatenate([edges - 1, v.max(axis=0)[:, None]], axis=1), low)
    codes = np.stack([np.searchsorted(edges[d], v[:, d], side="right") for d in range(6)], axis=1)
    tables = m.Intervals(r.integers(-200, 200, (9, 6)), low, high)
    exact = tables.distances(v)
    least = sum(tables.least[d][codes[:, d]] for d in range(6))
    most = sum(tables.most[d][codes[:, d]] for d in range(6))
    assert (least <= exact).all() and (exact <= most).all()
    assert tables.left(codes)[np.arange(500), exact.argmin(axis=1)].all()


def test_ties_copies_and_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [(i % 7, [0.25 * (i % 3), -0.5]) for i in range(60)] + [(None, [0.1, 0.1]), (None, None), (90, [0.1]), (91, []), (92, [None, 0.1]), (93, [nan, 0.1]), (94, [0.1, -inf]), (95, [0.1, 0.2, 0.3])]
    for k in (1, 5, 100):
        expected, centres = brute(data, k, 5, 2)
        rows, found = run(spark, data, k=k, dims=2)
        assert rows == expected and found.centroids == centres


def test_empty_and_too_large(spark):
    rows, found = run(spark, [])
    assert rows == [] and found.centroids == []
    with pytest.raises(Exception, match="would not fit 64 bits"):
        run(spark, [(1, [1e30] * 64)])


def test_query_digests(spark, workdir):
    from kerbside.llm.queries import op12_vafile_clusters

    data = grouped(120, 64, 5)
    spark.createDataFrame([(i, v, "x") for i, v in data], SCHEMA).write.parquet(f"{workdir}/embeddings.parquet")
    expected, centres = brute(data, 40, 5, 64)
    got = {r["vec_id"]: r for r in op12_vafile_clusters(spark, workdir).collect()}
    assert len(got) == 120
    for i, cluster, distance in expected:
        r = got[i]
        assert (r["cluster"], r["distance"], r["inertia"]) == (cluster, distance, sum(x[2] for x in expected))
        assert r["cluster_inertia"] == sum(x[2] for x in expected if x[1] == cluster)
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centres[cluster])).encode()).hexdigest()
