from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from kerbside.operators.point_in_time import as_of_join, starts_not_after

HISTORY = "k long, name string, valid_from timestamp_ntz, valid_to timestamp_ntz"
ROWS = "row long, key long, at timestamp_ntz"


def _t(day: float) -> dt.datetime:
    return dt.datetime(2020, 1, 1) + dt.timedelta(days=day)


def brute(rows: list, history: list) -> set:
    out = set()
    for row, key, at in rows:
        held = [h for h in history if h[0] == key and key is not None and at is not None and h[2] is not None
                and (h[3] is None or h[2] < h[3]) and h[2] <= at]
        last = max(held, key=lambda h: (h[2], h[3] or dt.datetime.max), default=None)
        out.add((row, key, at, last[1] if last and (last[3] is None or at < last[3]) else None))
    return out


def run(spark, rows, history, how="left"):
    got = as_of_join(spark.createDataFrame(rows, ROWS), spark.createDataFrame(history, HISTORY), "key", "at", "k", ["name"], how=how)
    return [tuple(r) for r in got.collect()]


def test_touching_intervals_gaps_and_odd_rows(spark):
    history = [
        (1, "a", _t(0), _t(10)), (1, "b", _t(10), _t(400)), (1, "c", _t(400), None),   # touching, over two years
        (2, "d", _t(5), _t(6)), (2, "e", _t(800), _t(900)),                            # gaps
        (3, "empty", _t(3), _t(3)), (3, "f", _t(3), _t(4)), (3, "back", _t(9), _t(8)),  # never valid ones beside
        (None, "x", _t(0), None), (4, "y", None, None),
    ]
    times = [-1, 0, 3, 3.5, 4, 5, 5.999, 6, 8.5, 9, 9.999, 10, 399.999, 400, 800, 899, 900, 5000]
    rows = [(100 * k + i, k, _t(x)) for k in (1, 2, 3, 4, 5) for i, x in enumerate(times)]
    rows += [(9001, None, _t(1)), (9002, 1, None), (9003, None, None)]
    got = run(spark, rows, history)
    assert len(got) == len(rows) and set(got) == brute(rows, history)
    inner = run(spark, rows, history, "inner")
    assert set(inner) == {r for r in brute(rows, history) if r[3] is not None}


def test_random_histories_with_many_versions(spark):
    r = random.Random(4)
    history = []
    for key in range(5):
        day = 0.0
        for v in range(300 if key == 0 else 12):
            start, day = day, day + r.choice([0.25, 1, 40, 200])
            if r.random() < 0.9:
                history.append((key, f"{key}-{v}", _t(start), _t(day)))
    rows = [(i, r.randrange(6), _t(r.choice([r.uniform(-5, 9000), round(r.uniform(0, 800) * 4) / 4]))) for i in range(4000)]
    got = run(spark, rows, history)
    assert len(got) == len(rows) and set(got) == brute(rows, history)


def test_overlap_goes_to_the_last_start(spark):
    history = [(1, "long", _t(0), _t(100)), (1, "short", _t(10), _t(20))]
    rows = [(0, 1, _t(5)), (1, 1, _t(15)), (2, 1, _t(30))]
    assert set(run(spark, rows, history)) == {(0, 1, _t(5), "long"), (1, 1, _t(15), "short"), (2, 1, _t(30), None)}


def test_empty_sides_and_clashes(spark):
    assert run(spark, [], [(1, "a", _t(0), None)]) == []
    assert run(spark, [(0, 1, _t(0))], []) == [(0, 1, _t(0), None)]
    with pytest.raises(ValueError, match="both sides"):
        as_of_join(spark.createDataFrame([], ROWS), spark.createDataFrame([], HISTORY), "key", "at", "k", ["row"])


def test_binary_search(spark):
    values = list(range(0, 200, 2))
    got = spark.range(-3, 205).select("id", starts_not_after(F.array(*[F.lit(v).cast("long") for v in values]), F.col("id")).alias("n"))
    assert all(r.n == sum(v <= r.id for v in values) for r in got.collect())


def test_plan_has_equality_joins_only(spark, workdir):
    spark.createDataFrame([(1, "a", _t(0), None)], HISTORY).write.parquet(f"{workdir}/h")
    rows = spark.range(1000).select(F.col("id").alias("row"), (F.col("id") % 3).alias("key"), F.lit(_t(3)).cast("timestamp_ntz").alias("at"))
    joined = as_of_join(rows, spark.read.parquet(f"{workdir}/h"), "key", "at", "k", ["name"])
    plan = joined._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_hot_key_is_not_multiplied(spark):
    history = [(1, f"v{i}", _t(i), _t(i + 1)) for i in range(500)]
    rows = spark.range(20_000).select(F.col("id").alias("row"), F.lit(1).cast("long").alias("key"), F.lit(_t(250.5)).cast("timestamp_ntz").alias("at"))
    got = as_of_join(rows, spark.createDataFrame(history, HISTORY), "key", "at", "k", ["name"])
    assert got.groupBy("name").count().collect()[0][:] == ("v250", 20_000)
