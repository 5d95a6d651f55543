from __future__ import annotations

import random
import re
from collections import Counter

from kerbside.llm import collocations as m
from tests.llm.cases import DOCUMENTS, awkward, prose, rows, with_clashes


def brute(docs: list, size: int = 3, least: int = 10, best: int = 2000) -> set:
    """The contract read literally, in exact integers."""
    f: dict = {}
    totals: Counter = Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        counts = f.setdefault(lang, Counter())
        lowered = re.sub("[A-Z]", lambda c: c.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, size + 1):
                counts.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = set()
    for lang, counts in f.items():
        found = []
        wanted = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        for p, a in wanted.items():
            if any(100 * b >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in wanted.items() if len(q) > len(p)):
                continue
            score, _, left, right = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:best], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return out


def table(spark, docs: list):
    return spark.createDataFrame([(i, t, lang, "s", None) for i, (t, lang) in enumerate(docs)], DOCUMENTS)


def run(spark, docs: list, **options) -> list:
    return [tuple(r) for r in m.collocations(table(spark, docs), **options).collect()]


def chatter(seed: int, n: int) -> str:
    r = random.Random(seed)
    return "".join(r.choice(["the ", "of ", "The\t", "sea ", "ÉTÉ ", "été  ", "a ", "new york ", "new york city ", ". ", ",", "\n", "; ", f"w{r.randrange(40)} "]) for _ in range(n))


def test_equals_brute_force(spark):
    docs = [(chatter(i, 300), (None, "en", "und", "fr", "")[i % 5]) for i in range(40)]
    got = run(spark, docs)
    assert len(got) == len(set(got)) > 50
    assert set(got) == brute(docs)


def test_longer_phrases_and_fewer_ranks(spark, monkeypatch):
    monkeypatch.setattr(m, "SLICE", 300)  # windows must not be lost where slices meet
    docs = [(chatter(i, 200), ("en", "fr")[i % 2]) for i in range(20)]
    assert set(run(spark, docs, size=4, min_count=5, best=30)) == brute(docs, 4, 5, 30)


def test_bitmaps_only_save_work(spark, monkeypatch):
    docs = [(prose(i, 200, 15) + ". " + prose(i + 50, 200, 4000), "en") for i in range(20)]
    expected = brute(docs)
    assert expected and set(run(spark, docs)) == expected
    every, some = (m.window_counts(table(spark, docs), 3, least).count() for least in (1, 10))
    assert some < every / 10
    monkeypatch.setattr(m, "MOST_BITS", 9)  # nearly every cell is taken, so hardly anything is padded
    monkeypatch.setattr(m, "LEAST_BITS", 9)
    assert set(run(spark, docs)) == expected


def test_hot_pair_and_copies(spark):
    docs = [("alpha beta gamma " * 400, "en")] * 30 + [(f"alpha beta w{i % 7}", "en") for i in range(200)]
    assert set(run(spark, docs)) == brute(docs)


def test_scores_pass_64_bits(spark):
    big = 10**14
    counts = spark.createDataFrame(
        [("en", None, None, None, 0, 9 * big), ("en", "a", None, None, 1, 3 * big), ("en", "b", None, None, 1, 2 * big + 1), ("en", "a", "b", None, 2, 2 * big - 7)],
        "lang string, w1 string, w2 string, w3 string, words int, f long",
    )
    (row,) = m.scored_phrases(counts, 3).collect()
    assert row["score"] == 1_000_000 * (2 * big - 7) ** 2 // (3 * big * (2 * big + 1))


def test_awkward_rows_and_empty_tables(spark):
    docs = awkward() * 3
    df = rows(spark, docs)
    expected = brute([(r["text"], r["lang"]) for r in df.collect()])
    assert {tuple(r) for r in m.collocations(with_clashes(df)).collect()} == expected
    assert run(spark, []) == []
    assert run(spark, [(None, None), ("", "en"), ("one two", "en")]) == []
