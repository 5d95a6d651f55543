from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kerbside.llm import langid as m
from kerbside.llm.queries import remainder

from .cases import awkward, rows, with_clashes

SYLLABLES = {"en": "the ing th er on an re he in ed".split(), "de": "sch ung ein ich der keit ü ß zu ver".split(), "es": "ción os ar do que la el ñ ie mente".split()}


def invented(lang: str, seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choices(SYLLABLES[lang], k=r.randrange(1, 4))) for _ in range(n))


def labelled(spark, n: int = 240):
    langs = sorted(SYLLABLES)
    return spark.createDataFrame([(i, invented(langs[i % 3], i, 5 + i % 60), langs[i % 3]) for i in range(n)], "doc_id long, text string, lang string")


def test_held_out_documents(spark):
    df = labelled(spark)
    got = {r.doc_id: r for r in m.identify_languages(with_clashes(df), remainder(4) != 2).collect()}
    want = {r.doc_id: r.lang for r in df.collect()}
    assert np.mean([got[i].lang_pred == want[i] for i in want]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_awkward_rows(spark):
    extra = rows(spark, [*awkward(), "123 456 !!", "中文"], start=1000).withColumn("lang", F.lit(None).cast("string")).select("doc_id", "text", "lang")
    got = m.identify_languages(labelled(spark, 60).unionByName(extra), F.lit(True)).collect()
    assert len(got) == 60 + extra.count()
    by_id = {r.doc_id: r for r in got}
    for i in (1000, 1001, 1002, 1016):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert by_id[1017].lang_pred in SYLLABLES
    assert m.identify_languages(rows(spark, []), F.lit(True)).collect() == []
    alone = m.identify_languages(rows(spark, ["some text"]).withColumn("lang", F.lit(None).cast("string")), F.lit(True)).collect()
    assert [r.lang_pred for r in alone] == ["und"]


def test_rows_in_known_language_keep_their_columns(spark):
    df = rows(spark, ["the thing there", None, "", "12 34", "hereing onan"])
    kept = m.rows_in_known_language(with_clashes(df), F.lit(True), 0.0)
    assert kept.columns == with_clashes(df).columns and sorted(r.doc_id for r in kept.collect()) == [0, 4]


def brute_phrases(sample: str, text: str) -> int:
    """Greedy longest phrases of text that occur in sample, anew every STRETCH symbols; a symbol that does not is a phrase."""
    n = 0
    for lo in range(0, len(text), m.STRETCH):
        own, at = text[lo : lo + m.STRETCH], 0
        while at < len(own):
            size = 1
            while at + size <= len(own) and own[at : at + size] in sample:
                size += 1
            at += max(1, size - 1)
            n += 1
    return n


def test_parsing_equals_brute_force():
    samples = {k: invented(k, 1, 300) for k in SYLLABLES}
    model = m.LanguageModel(samples)
    texts = [invented("en", 50 + i, 1 + 40 * i) for i in range(12)] + ["q", "", "zzz ñ 12 中"]
    as_text = lambda s: "".join(chr(48 + x) for x in s)
    symbols = {k: as_text(m.symbols(np.array([ord(c) for c in v]), np.array([0, len(v)]), model.table)[0]) for k, v in samples.items()}
    points = np.array([ord(c) for c in "".join(texts)], np.int64)
    starts = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    row, ends = m.symbols(points, starts, model.table)
    model.score(pa.array(texts))
    got = m.phrases(row, ends, model._dense)
    for i in range(len(texts)):
        own = as_text(row[ends[i] : ends[i + 1]])
        for j, k in enumerate(model.languages):
            assert got[i, j] == brute_phrases(symbols[k], own)
