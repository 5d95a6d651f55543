from __future__ import annotations

import math
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm import topk_search as m

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("score", T.IntegerType())])


def brute(data: list, k: int) -> set:
    good = {(i, tuple(math.floor(64 * x) for x in v)) for i, v in data if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q, v in good:
        if q % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), c) for c, w in good if c != q and len(w) == len(v))
            out |= {(q, rank + 1, c, -s) for rank, (s, c) in enumerate(scored[:k])}
    return out


def run(spark, data: list, k: int = 20) -> list:
    df = spark.createDataFrame([(i, v, 0) for i, v in data], SCHEMA)
    return [tuple(r) for r in m.top_k_inner_products(df, F.col("vec_id") % 20 == 0, k).collect()]


def vectors(n: int, dims: int, seed: int = 0) -> list:
    import numpy as np

    r = random.Random(seed)
    return [(i, [float(np.float32(r.gauss(0, 0.3))) for _ in range(dims)]) for i in range(n)]


def test_equals_brute_force_over_many_cells(spark, monkeypatch):
    monkeypatch.setattr(m, "CELL", 60)
    monkeypatch.setattr(m, "QUERY_CELL", 4)
    data = vectors(300, 24)
    got = run(spark, data)
    assert set(got) == brute(data, 20) and len(got) == 15 * 20


def test_ties_nulls_and_odd_lengths(spark):
    data = [(i, [0.5, 0.25]) for i in range(50)] + [(60, None), (80, []), (100, [0.5, None]), (120, [0.5, math.nan]), (140, [math.inf, 1.0]), (None, [0.5, 0.5]), (160, [1.0]), (180, [2.0]), (3, [0.5, 0.25]), (3, [0.75, 0.25])]
    got = run(spark, data, 5)
    assert set(got) == brute(data, 5)
    assert [r[2] for r in sorted(got) if r[0] == 0][:2] == [3, 1]


def test_fewer_than_k_and_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 64 * 128)]


def test_bounds_hold():
    import numpy as np

    r = np.random.default_rng(1)
    a, b = r.normal(size=(30, 50)), r.normal(size=(30, 50))
    exact = a @ b.T
    before = None
    for s in m.SEGMENTS:
        bound = m.segment_statistics(a, s) @ m.segment_statistics(b, s).T
        assert (bound >= exact - 1e-9).all()
        assert before is None or (bound <= before + 1e-9).all()
        before = bound
