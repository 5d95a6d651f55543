"""The registered queries as the driver calls them: columns, folds and thresholds."""
from __future__ import annotations

import zlib

import pytest

from kerbside.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(("name", "folds", "held", "threshold"), [("op4_quality_mil", 5, 0, 0.3), ("op6_toxicity", 3, 1, 0.7), ("op9_language_id", 4, 2, None)])
def test_folds_and_thresholds(spark, name, folds, held, threshold):
    docs = sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
    got = queries.QUERIES[name](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == docs
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held)
        assert 0 <= r.score <= 1
        if threshold is not None:
            assert r.predicted == int(r.score >= threshold)
        else:
            assert isinstance(r.lang_pred, str)


def test_every_query_is_registered_once():
    numbers = [int(n[2:].split("_")[0]) for n in queries.QUERIES]
    assert numbers == list(range(1, 14))
    assert set(queries.ORACLE) <= set(queries.QUERIES)
