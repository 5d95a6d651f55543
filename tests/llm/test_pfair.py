from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kerbside.llm import pfair as m

from .cases import awkward, rows, with_clashes


@settings(max_examples=100, deadline=None, derandomize=True)
@given(st.lists(st.floats(0.001, 100), min_size=1, max_size=12))
def test_one_period_deviates_less_than_a_block(weights):
    parts = m.weight_parts(weights, 60)
    slots = m.one_period(parts)
    assert sum(parts) == 60 and sorted(t for own in slots for t in own) == list(range(60))
    for t in range(61):
        for s, own in enumerate(slots):
            assert abs(sum(x < t for x in own) - parts[s] * t / 60) < 1


def sourced(spark, counts: dict):
    data = [(i, f"text {s} {k}", "en", s, 10) for i, (s, k) in enumerate((s, k) for s, n in counts.items() for k in range(n))]
    return spark.createDataFrame(data, rows(spark, []).schema)


def test_mix_keeps_weights_and_every_document(spark):
    counts, block = {"a": 120, "b": 40, "c": 9, None: 30}, 4
    weights = {"a": 0.5, "b": 0.2, "c": 0.1, None: 0.2}
    got = m.pfair_mix(sourced(spark, counts), weights, block=block, parts=100).orderBy("mix_position").collect()
    assert [r.mix_position for r in got] == list(range(len(got)))
    assert {r.doc_id for r in got} == set(range(199))
    seen: Counter = Counter()
    for slot in range(len(got) // block):
        own = {r.source for r in got[slot * block : (slot + 1) * block]}
        assert len(own) == 1
        seen.update(own)
        assert all(abs(seen[s] - w * (slot + 1)) < 1.25 for s, w in weights.items())  # weights are rounded to hundredths
    by_source = Counter((r.source, r.doc_id) for r in got)
    for s in counts:  # a source starts over only when all of it has been read
        times = [n for (x, _), n in by_source.items() if x == s]
        assert max(times) - min(times) <= 1


def test_buckets_give_ranks_without_gaps(spark, monkeypatch):
    monkeypatch.setattr(m, "_BUCKET_ROWS", 7)
    got = m.pfair_mix(sourced(spark, {"a": 100, "b": 33}), block=5).collect()
    assert sorted(r.mix_position for r in got) == list(range(len(got)))


def test_weights_must_cover_sources(spark):
    with pytest.raises(ValueError, match="no positive weight"):
        m.pfair_mix(sourced(spark, {"a": 2, "b": 2}), {"a": 1.0})


def test_awkward_rows(spark):
    df = with_clashes(rows(spark, awkward()))
    got = m.pfair_mix(df).collect()
    assert sorted(r.mix_position for r in got) == list(range(len(got)))
    assert Counter((r.doc_id, r.text) for r in got if r.mix_epoch == 0) == Counter((r.doc_id, r.text) for r in df.collect())
    assert m.pfair_mix(rows(spark, [])).collect() == []
