from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kerbside.llm import quality_mil, toxicity
from kerbside.llm.queries import remainder

from .cases import awkward, prose, rows, with_clashes


def labels(spark, data):
    return spark.createDataFrame(data, "doc_id long, label int")


def quality_data(n: int):
    r = random.Random(8)
    out = []
    for i in range(n):
        good = prose(i, r.randrange(40, 300))
        bad = " | ".join(f"{w}***" for w in prose(i + 10_000, 80).split())
        out.append(good if i % 3 else f"{good} {bad}")
    return out


def test_quality_separates_held_out_documents(spark):
    texts = quality_data(240)
    df, known = rows(spark, texts), labels(spark, [(i, int(i % 3 > 0)) for i in range(240)])
    got = {r.doc_id: r.score for r in quality_mil.score_quality(with_clashes(df), known, remainder(5) != 0).collect()}
    assert len(got) == 240
    held = [r.doc_id for r in df.filter(remainder(5) == 0).collect()]
    assert np.mean([(got[i] >= 0.5) == (i % 3 > 0) for i in held]) > 0.95


def test_quality_of_awkward_rows_and_no_labels(spark):
    df = rows(spark, awkward())
    none = labels(spark, [])
    got = quality_mil.score_quality(with_clashes(df), none, F.lit(True)).collect()
    assert len(got) == df.count() and all(0 <= r.score <= 1 for r in got)
    assert quality_mil.score_quality(rows(spark, []), none, F.lit(True)).collect() == []


def test_labels_of_held_out_rows_do_not_matter(spark):
    df = rows(spark, quality_data(60))
    known = [(i, int(i % 3 > 0)) for i in range(60)]
    held = {r.doc_id for r in df.filter(remainder(5) == 0).collect()}
    flipped = [(i, 1 - v if i in held else v) for i, v in known]
    scores = [sorted(tuple(r) for r in quality_mil.score_quality(df, labels(spark, k), remainder(5) != 0).collect()) for k in (known, flipped)]
    assert scores[0] == scores[1]


def test_passages_of_slices_equal_those_of_one_text():
    texts = [prose(1, 300), "", prose(2, 10), "A!! B!! | ***"]
    x, where = quality_mil.passages(pa.array(texts))
    for i, text in enumerate(texts):
        own, ends = quality_mil.passages(pa.array([text]))
        assert np.allclose(x[where[i] : where[i + 1]], own) and ends[-1] == where[i + 1] - where[i]


def test_attention_gradient():
    r = np.random.default_rng(0)
    x, starts, y = r.normal(size=(12, 6)), np.array([0, 3, 4, 12]), np.array([1.0, 0.0, 1.0])
    model = quality_mil.AttentionModel(6)
    before = -(y * np.log(model.score(x, starts)) + (1 - y) * np.log(1 - model.score(x, starts))).mean()
    model.fit(x, starts, y)
    after = -(y * np.log(model.score(x, starts)) + (1 - y) * np.log(1 - model.score(x, starts))).mean()
    assert after < before / 5


def toxic_data(n: int):
    r = random.Random(3)
    out = []
    for i in range(n):
        w = prose(i, r.randrange(30, 200)).split()
        if i % 6 == 0:
            for bad in r.sample(["idiot", "scum", "clown", "stupid", "worthless"], 3):
                w.insert(r.randrange(len(w)), bad)
        elif i % 6 == 1:  # another language: invented words with one beginning
            for _ in range(3):
                w.insert(r.randrange(len(w)), f"grumbl{r.choice(['a', 'o', 'us', 'en', 'ix'])}{r.choice(['t', 'k', 'm'])}")
        out.append(" ".join(w))
    return out


def test_toxicity_finds_listed_and_mined_words_of_held_out_documents(spark):
    texts = toxic_data(600)
    df, known = rows(spark, texts), labels(spark, [(i, int(i % 6 < 2)) for i in range(0, 600)])
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(with_clashes(df), known, remainder(3) != 1).collect()}
    held = [r.doc_id for r in df.filter(remainder(3) == 1).collect()]
    assert np.mean([(got[i] >= 0.7) == (i % 6 < 2) for i in held]) > 0.95


def test_toxicity_of_awkward_rows_and_no_labels(spark):
    df = rows(spark, awkward())
    got = toxicity.score_toxicity(with_clashes(df), labels(spark, []), F.lit(True)).collect()
    assert len(got) == df.count() and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score_toxicity(rows(spark, []), labels(spark, []), F.lit(True)).collect() == []


def test_label_model_recovers_accuracies():
    r = np.random.default_rng(2)
    toxic = r.random(20_000) < 0.1
    bits = np.zeros((20_000, toxicity.VOTERS), bool)
    for j, (hit, false) in enumerate([(0.8, 0.01), (0.6, 0.02), (0.7, 0.005)]):
        bits[:, j] = r.random(20_000) < np.where(toxic, hit, false)
    codes = (bits << np.arange(toxicity.VOTERS)).sum(axis=1)
    counts: dict = {}
    for i, code in enumerate(codes.tolist()):
        key = (code, int(toxic[i]) if i % 3 == 0 else None)
        counts[key] = counts.get(key, 0) + 1
    model = toxicity.LabelModel(counts)
    assert np.allclose(model.rates[:3, 1], [0.8, 0.6, 0.7], atol=0.05)
    assert np.allclose(model.rates[:3, 0], [0.01, 0.02, 0.005], atol=0.01)
